"""BPE encoding and decoding as bounded-lookahead streaming transducers.

*Lookahead.* A merge is decided by what stands to its right only through chains
of merges that overlap at their ends, each with a smaller rank than the one
before. ``sufficient_lookahead`` finds the longest such chain in the merge list;
times the longest token it bounds how far a boundary between tokens can depend
on what follows. Boundaries further from the end of the buffer are final, and
what stands after a final boundary is merged independently of what was before.

*Encoding.* A text is read in slices that end at a space, normalised and cut into
pre-tokens. Inside a pre-token the transducer holds a buffer of bounded length:
tokens that end before the lookahead are emitted, the rest waits for more. Merges
of short pre-tokens are remembered in a table of bounded size, which the frequent
ones enter first.

*Decoding.* A state machine takes ids one by one. For a vocabulary without a
decoder, token strings are joined by spaces, as its library does; with a
byte-level decoder, bytes are turned into text as soon as a character is
complete, and broken sequences into replacement characters.

The rules (normalisation, pattern, word end, merges, special tokens) come from a
public tokenizer file, whose path is a parameter. Defined results: a null text
counts as empty and has no tokens. Character classes and lower case are those of
the installed ``regex`` and Python; a tokenizer library built on another Unicode
version can differ on letters that were added between the two.
"""

import codecs
import hashlib
import heapq
import json
import unicodedata
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_SLICE = 1 << 16
_BUFFER = 4096
_KNOWN_LIMIT = 400_000
_KNOWN_LENGTH = 48


def byte_alphabet():
    """The printable character that stands for each byte: itself if printable Latin-1, else from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def sufficient_lookahead(merges):
    """Number of symbols to the right that can decide a boundary between tokens.

    ``chain[r]`` is the longest chain that starts with merge ``r``: the next one
    has a smaller rank and takes, as its left part, a token at the right edge
    of ``r``'s right part.
    """
    right_part, longest_from, longest = {}, {}, 1
    length = {}
    for left, right in merges:
        edge, chain = right, 0
        while edge is not None:
            chain = max(chain, longest_from.get(edge, 0))
            edge = right_part.get(edge)
        chain += 1
        longest = max(longest, chain)
        longest_from[left] = max(longest_from.get(left, 0), chain)
        right_part.setdefault(left + right, right)
        for part in (left, right):
            length.setdefault(part, 1)
        length[left + right] = length[left] + length[right]
    return longest * max(length.values(), default=1)


class Transducer:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, source):
        rules = json.loads(source)
        model = rules["model"]
        self.vocabulary = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.word_end = model.get("end_of_word_suffix") or ""
        self.lookahead = sufficient_lookahead(merges)
        self.special = {t["content"]: t["id"] for t in rules.get("added_tokens", ())}
        self.pattern = regex.compile(_pattern(rules["pre_tokenizer"]))
        self.steps = [_NORMALIZERS[n["type"]](n) for n in _listed(rules.get("normalizer"), "normalizers")]
        self.letters = byte_alphabet()
        self.tokens = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.special.items()}
        self.joins = rules.get("decoder") is None
        self.splitter = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.known = {}

    def merge(self, symbols):
        """Tokens of a symbol sequence: the best-ranked pair first, the leftmost of equals."""
        rank = self.rank
        if len(symbols) <= 32:
            ranks = [rank.get(p, _NEVER) for p in pairwise(symbols)]
            while ranks and (best := min(ranks)) != _NEVER:
                i = ranks.index(best)
                symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank.get((symbols[i - 1], symbols[i]), _NEVER)
                if i < len(ranks):
                    ranks[i] = rank.get((symbols[i], symbols[i + 1]), _NEVER)
            return symbols
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        symbols.append(None)
        heap = [(rank[p], i, *p) for i, p in enumerate(pairwise(symbols[:-1])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= len(after) or symbols[j] != right:
                continue
            symbols[i], symbols[j] = left + right, None
            after[i] = after[j]
            if after[i] < len(after):
                before[after[i]] = i
                pair = symbols[i], symbols[after[i]]
                if pair in rank:
                    heapq.heappush(heap, (rank[pair], i, *pair))
            if before[i] >= 0:
                pair = symbols[before[i]], symbols[i]
                if pair in rank:
                    heapq.heappush(heap, (rank[pair], before[i], *pair))
        return [s for s in symbols if s is not None]

    def word_tokens(self, word):
        """Tokens of a pre-token, emitted once they are stable."""
        raw = word.encode("utf-8")
        letters = self.letters
        size = max(_BUFFER, 2 * self.lookahead)
        waiting, at = [], 0
        while True:
            room = size - len(waiting)
            waiting += [letters[b] for b in raw[at : at + room]]
            at += room
            if at >= len(raw):
                if waiting:
                    waiting[-1] += self.word_end
                yield from self.merge(waiting)
                return
            covered, stable = 0, 0
            merged = self.merge(waiting.copy())
            for token in merged:
                if covered + len(token) > size - self.lookahead:
                    break
                covered += len(token)
                stable += 1
            yield from merged[:stable]
            waiting = waiting[covered:]

    def _word(self, word):
        """``(number of tokens, ids, tokens)`` of a pre-token, both joined by spaces."""
        tokens = list(self.word_tokens(word))
        found = len(tokens), " ".join(str(self.vocabulary[t]) for t in tokens), " ".join(tokens)
        if len(word) <= _KNOWN_LENGTH:
            if len(self.known) < _KNOWN_LIMIT:
                self.known[word] = found
        return found

    def pretokens(self, text):
        """Lists of pre-tokens and special tokens of successive slices, as ``(is special, words)``."""
        at = 0
        for special in self.splitter.finditer(text):
            yield from self._plain(text, at, special.start())
            yield True, [special.group()]
            at = special.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text, start, stop):
        while start < stop:
            end = min(stop, start + _SLICE)
            if end < stop:
                cut = text.rfind(" ", start + 1, end)
                cut = cut if cut > 0 else text.find(" ", end, stop)
                end = cut if cut > 0 else stop
            part = text[start:end]
            for step in self.steps:
                part = step(part)
            yield False, self.pattern.findall(part)
            start = end

    def stream(self, text):
        """``(number of tokens, ids, tokens)`` of successive slices; ids and tokens joined by spaces."""
        known = self.known
        for special, words in self.pretokens(text):
            if special:
                yield 1, str(self.special[words[0]]), words[0]
            elif words:
                rows = [known.get(w) or self._word(w) for w in words]
                yield sum(r[0] for r in rows), " ".join([r[1] for r in rows]), " ".join([r[2] for r in rows])

    def encode(self, text):
        """Ids of a text; none for a null."""
        return [int(i) for _, ids, _ in self.stream(text or "") for i in ids.split(" ")]

    def decode(self, ids):
        decoder = Decoder(self)
        return "".join(map(decoder.feed, ids)) + decoder.end()


class Decoder:
    """Takes ids, gives text as soon as it is certain."""

    def __init__(self, transducer):
        self.tokens, self.joins, self.special = transducer.tokens, transducer.joins, set(transducer.special.values())
        self.first = True
        self.bytes = {c: b for b, c in enumerate(transducer.letters)}
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token_id):
        token = self.tokens.get(token_id)
        if token is None:
            return ""
        if self.joins:
            text = token if self.first else " " + token
            self.first = False
            return text
        if token_id in self.special:
            return self.state.decode(b"", True) + token
        return self.state.decode(bytes(self.bytes[c] for c in token))

    def end(self):
        return "" if self.joins else self.state.decode(b"", True)


_NEVER = 1 << 60

def _lower(text):
    """Lower case of each character by itself: no final sigma."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


def _replacement(rule):
    pattern = regex.compile(rule["pattern"]["Regex"])
    return lambda text: pattern.sub(rule["content"], text)


_NORMALIZERS = {
    "NFC": lambda rule: lambda text: unicodedata.normalize("NFC", text),
    "Lowercase": lambda rule: _lower,
    "Replace": _replacement,
}


def _listed(rule, name):
    return [] if rule is None else rule[name] if rule["type"] == "Sequence" else [rule]


def _pattern(rule):
    """The splitting pattern, with whitespace as Unicode defines it."""
    for part in _listed(rule, "pretokenizers"):
        if part["type"] == "Split":
            return part["pattern"]["Regex"]
    raise ValueError("the tokenizer file has no splitting pattern")


def load(spark: SparkSession, path: str):
    """Broadcast JSON text of a tokenizer file, which has a fixed size."""
    with open(path, encoding="utf-8") as source:
        return spark.sparkContext.broadcast(source.read())


def _machine(source):
    """The transducer of a broadcast file; made once in a process."""
    if not hasattr(source, "transducer"):
        source.transducer = Transducer(source.value)
    return source.transducer


def encode_column(text: Column, source) -> Column:
    """Array of the ids of each whole text."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return pa.array([_machine(source).encode(t.as_py()) for t in texts], pa.list_(pa.int32()))

    return encode(text)


def decode_column(ids: Column, source) -> Column:
    """Text of each array of ids; null for a null array."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        values = (r.as_py() for r in rows)
        return pa.array([None if v is None else _machine(source).decode(v) for v in values], pa.string())

    return decode(ids)


def digest_column(text: Column, source) -> Column:
    """Struct ``n_tokens, ids_sha256, decoded_sha256`` of each whole text, computed along the stream.

    The decoded text comes from the same stream when the file has no decoder,
    as its token strings are then the decoded text.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(texts: pa.Array) -> pa.Array:
        machine, rows = _machine(source), []
        for text in texts:
            count, ids, decoded, gap = 0, hashlib.sha256(), hashlib.sha256(), b""
            decoder = None if machine.joins else Decoder(machine)
            for n, some_ids, some_tokens in machine.stream(text.as_py() or ""):
                count += n
                ids.update(gap + some_ids.encode())
                if decoder:
                    decoded.update("".join(decoder.feed(int(i)) for i in some_ids.split(" ")).encode())
                else:
                    decoded.update(gap + some_tokens.encode())
                gap = b" "
            if decoder:
                decoded.update(decoder.end().encode())
            rows.append((count, ids.hexdigest(), decoded.hexdigest()))
        columns = list(zip(*rows)) or [[], [], []]
        kinds = [pa.int64(), pa.string(), pa.string()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return digest(text)
