"""Substring dedup by relative Lempel-Ziv parsing against indexed blocks.

Every text is cut into overlapping blocks at its own content: neighbouring
35-word windows whose least 8-word hash (the block's *seed*) is the same one
form a block, so that equal passages are cut alike wherever they stand. All
blocks of all documents are reference blocks: they are indexed by seed and
content, and a content that occurs twice or more keeps its least and its greatest
place (document, block) as references. A document is parsed from left to right:

* a block whose content occurs elsewhere begins a factor, a copy of the
  reference from which most blocks can be copied on in the reference's own
  order; the factor goes on while the next block follows in that reference;
* a block with a seed that occurs elsewhere, but with other words around it, is
  a factor boundary: copies begin or end in it. It is checked window by window
  against the windows of all such blocks;
* any other block has no copy of any of its windows, and no factor passes
  through it.

Factors and checked windows together are the duplicate spans. Each window lies
inside one block, so a factor is at least a window long, no repeated window is
missed, and every word of a span is in a repeated window. A factor is greedy
over two references of each block, not over all occurrences: a passage that a
third of all documents share costs one counter per task, and a longer copy in a
third place may be told as two factors; the spans are the same. Blocks and
windows are counted with map-side sums and texts are shuffled once, by a key of
the whole row.

Windows are compared by 96-bit hashes of their words.

Defined results: a null or empty text has no words; texts under a window long
keep all words; equal rows are copies of each other, so all their windows
repeat; windows are judged on the input, not on what is left. Any type of
``doc_id`` and nulls in it are carried through. Other columns are not read, or
(``drop_repeated``) kept as they are.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import UNCHANGED, byte_slices, mix, ngram_hashes, slices, text_word_hashes
from starloom.session import work_folder

WINDOW = 35
SEED = 8
#: Longer texts are cut into blocks in stretches of so many windows.
_STRETCH = 1 << 20
_POSITION = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15
_BASE2 = 0xC2B2AE3D27D4EB4F
_RESULT = "n_words bigint, n_removed bigint, kept string, spans array<struct<first:int,end:int>>"


def cut_blocks(hashes, window=WINDOW, seed=SEED):
    """First windows and seed hashes of the blocks of a text, given its word hashes."""
    firsts, seeds = [], []
    for start in range(0, len(hashes) - window + 1, _STRETCH):
        part = hashes[start : start + _STRETCH + window - 1]
        grams = ngram_hashes(part, seed)
        keys = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        # Least key of each run of window - seed + 1, by doubling.
        least, width, wanted = keys, 1, window - seed + 1
        while 2 * width <= wanted:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        rest = wanted - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        at = (least & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        firsts.append(first + start)
        seeds.append(grams[at[first]])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(seeds)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64."""

    def __init__(self, base):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers(_BASE)


def run_hashes(hashes, first, end):
    """Hash of the words ``first`` to ``end`` (exclusive), whatever their place, for arrays of both."""
    up, down = _POWERS.get(len(hashes) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64)))
        return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))


def _hashed(batch):
    """``(row, text as bytes, word hashes)`` of each text of a batch."""
    row = 0
    for texts in byte_slices(batch.column(batch.schema.get_field_index("text"))):
        hashes, bounds = text_word_hashes(texts, UNCHANGED)
        for text, start, end in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist()):
            yield row, text, hashes[start:end]
            row += 1


def _numbers(batch, name):
    return batch.column(batch.schema.get_field_index(name)).to_numpy()


def _lists(column):
    """Values of a list column, and where each row's begin and end; a null is an empty list."""
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return column.flatten(), np.concatenate(([0], lengths.cumsum()))


def _written(df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _signed(parts, kind=np.int64):
    values = np.concatenate(parts) if parts else np.zeros(0, kind)
    return pa.array(values.astype(kind, copy=False) if values.dtype.itemsize != np.dtype(kind).itemsize else values.view(kind))


def _emit_blocks(window, seed):
    def emit(batches):
        for batch in slices(batches):
            a, b = _numbers(batch, "k1"), _numbers(batch, "k2")
            row, number, start, seeds, content = [], [], [], [], []
            for i, _, hashes in _hashed(batch):
                if len(hashes) < window:
                    continue
                first, grams = cut_blocks(hashes, window, seed)
                end = np.concatenate((first[1:], [len(hashes) - window + 1])) + window - 1
                row.append(np.full(len(first), i))
                number.append(np.arange(len(first), dtype=np.int32))
                start.append(first.astype(np.int32))
                seeds.append(grams)
                content.append(run_hashes(hashes, first, end))
            row = np.concatenate(row) if row else np.zeros(0, np.int64)
            columns = [pa.array(a[row]), pa.array(b[row]), _signed(number, np.int32), _signed(start, np.int32), _signed(seeds), _signed(content)]
            names = ["k1", "k2", "block", "first", "seed", "content", "doc"]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("doc").take(pa.array(row))], names)

    return emit


def _window_hashes(hashes, window):
    second = ngram_hashes(mix(hashes ^ np.uint64(_BASE2)), window, _BASE2)
    return ngram_hashes(hashes, window), (second >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _block_windows(hashes, blocks, window, seed):
    """Mask of the windows that lie in the given blocks."""
    first, _ = cut_blocks(hashes, window, seed)
    n = len(hashes) - window + 1
    inside = np.zeros(len(first), bool)
    inside[blocks] = True
    return np.repeat(inside, np.diff(np.concatenate((first, [n]))))


def _emit_windows(window, seed):
    def emit(batches):
        for batch in slices(batches):
            a, b = _numbers(batch, "k1"), _numbers(batch, "k2")
            edges, bounds = _lists(batch.column(batch.schema.get_field_index("edges")))
            edges = edges.to_numpy()
            row, at, h1, h2 = [], [], [], []
            for i, _, hashes in _hashed(batch):
                place = np.flatnonzero(_block_windows(hashes, edges[bounds[i] : bounds[i + 1]], window, seed))
                one, two = _window_hashes(hashes, window)
                row.append(np.full(len(place), i))
                at.append(place.astype(np.int32))
                h1.append(one[place])
                h2.append(two[place])
            row = np.concatenate(row) if row else np.zeros(0, np.int64)
            columns = [pa.array(a[row]), pa.array(b[row]), _signed(at, np.int32), _signed(h1), _signed(h2, np.int32)]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "at", "h1", "h2"])

    return emit


def factors(copies):
    """Greedy parse: ``(first block, number of blocks, reference)`` of each factor.

    ``copies`` are the blocks with a copy, in order: ``(block, references)``,
    a reference being ``(document, block, ...)``. A factor takes the reference
    that can be followed longest.
    """
    runs = {}
    for block, references in reversed(copies):
        after = runs.get(block + 1, ())
        runs[block] = [
            (1 + max([n for n, other in after if other[0] == r[0] and other[1] == r[1] + 1], default=0), r) for r in references
        ]
    found, at = [], 0
    for block, _ in copies:
        if block >= at:
            n, reference = max(runs[block], key=lambda run: run[0])
            found.append((block, n, reference))
            at = block + n
    return found


def duplicate_spans(hashes, parsed, checked, window=WINDOW, seed=SEED):
    """Spans ``(first word, end)`` of the factors, and of these together with the repeated windows at factor boundaries."""
    n = len(hashes) - window + 1
    first = np.append(cut_blocks(hashes, window, seed)[0], n)
    copied = [(int(first[b]), int(first[b + k]) + window - 1) for b, k, _ in parsed]
    repeated = np.zeros(n, bool)
    for a, b in copied:
        repeated[a : b - window + 1] = True
    if len(checked):
        repeated[np.array(checked)] = True
    edge = np.flatnonzero(np.diff(np.concatenate(([False], repeated, [False])).astype(np.int8)))
    return copied, [(int(a), int(b) + window - 1) for a, b in zip(edge[::2], edge[1::2])]


def _kept_words(words, spans):
    kept, at = [], 0
    for first, end in spans:
        if first > at:
            kept += words[at:first]
        at = max(at, end)
    return kept + words[at:] if spans else words


class _Copies:
    """The copied blocks of a batch of documents, each with two references."""

    def __init__(self, column):
        values, self.bounds = _lists(column)
        self.blocks = values.field("block").to_numpy()
        self.places, self.docs = [], []
        for name in ("low", "high"):
            place = values.field(name)
            self.places.append([place.field(c).to_numpy() for c in ("k1", "k2", "block", "first")])
            self.docs.append(place.field("doc"))

    def of(self, row):
        """``(block, references)`` of a document, in order; the third part of a reference says where it is kept."""
        start, end = self.bounds[row : row + 2]
        if start == end:
            return []
        order = start + np.argsort(self.blocks[start:end], kind="stable")
        columns = [[c[order].tolist() for c in side[:3]] for side in self.places]
        sides = [zip(zip(k1, k2), block, [(side, at) for at in order.tolist()]) for side, (k1, k2, block) in enumerate(columns)]
        return list(zip(self.blocks[order].tolist(), zip(*sides)))

    def told(self, spans):
        """Lists of factors for ``(row's spans, references)``."""
        kind = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("doc", self.docs[0].type), ("doc_first", pa.int32())])
        lengths = [len(s) for s in spans]
        flat = [f for s in spans for f in s]
        docs = [self.docs[side][at].as_py() for _, _, (side, at) in flat]
        firsts = [int(self.places[side][3][at]) for _, _, (side, at) in flat]
        columns = [[f[0] for f in flat], [f[1] for f in flat], docs, firsts]
        values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), values)


def _apply(window, seed, digest):
    def apply(batches):
        for batch in slices(batches):
            totals, removed, texts, all_spans, all_factors = [], [], [], [], []
            copies = _Copies(batch.column(batch.schema.get_field_index("copies")))
            checked, bounds = _lists(batch.column(batch.schema.get_field_index("checked")))
            checked = checked.to_numpy()
            for i, text, hashes in _hashed(batch):
                copied, windows = copies.of(i), checked[bounds[i] : bounds[i + 1]]
                words, spans, told = (text or b"").split(), [], []
                if copied or len(windows):
                    parsed = factors(copied)
                    places, spans = duplicate_spans(hashes, parsed, windows, window, seed)
                    told = [(a, b, where) for (a, b), (_, _, (_, _, where)) in zip(places, parsed)]
                kept = _kept_words(words, spans)
                joined = b" ".join(kept)
                totals.append(len(words))
                removed.append(len(words) - len(kept))
                if digest:
                    texts.append(hashlib.sha256(joined).hexdigest())
                else:
                    texts.append(joined.decode("utf-8") if spans else None if text is None else text.decode("utf-8"))
                all_spans.append([{"first": a, "end": b} for a, b in spans])
                all_factors.append(told)
            columns = [
                batch.column(batch.schema.get_field_index("row")),
                pa.array(totals, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(texts, pa.string()),
                pa.array(all_spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                copies.told(all_factors),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "n_removed", "kept", "spans", "factors"])

    return apply


def parse(documents: DataFrame, carry, digest=False, window=WINDOW, seed=SEED) -> DataFrame:
    """``row`` (struct of the columns ``carry`` without the text), ``n_words, n_removed, kept, spans, factors`` of each document.

    ``kept`` is the text without its duplicate spans (words joined by one
    space; a text without such spans unchanged), or with ``digest`` the SHA-256
    of the kept words joined by one space. A factor names its first word and end
    and the document and first word it is a copy of.
    """
    carried = [c for c in carry if c != "text"]
    # The columns lie in a struct of their own, whatever their names.
    row = F.struct(F.lit(0).alias("none"), F.struct(*[F.col(f"`{c}`").alias(c) for c in carried] or [F.lit(0).alias("none")]).alias("columns"))
    keyed = documents.select(
        F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2"), "text", row.alias("row"), F.col("doc_id").alias("doc")
    )
    keys = ["k1", "k2"]
    folder = work_folder(documents.sparkSession, "substrings")
    fields = "k1 bigint, k2 int, block int, first int, seed bigint, content bigint"
    doc = T.StructField("doc", documents.schema["doc_id"].dataType)
    blocks = _written(
        keyed.select(*keys, "text", "doc").mapInArrow(
            _emit_blocks(window, seed), T.StructType([*T.StructType.fromDDL(fields).fields, doc])
        ),
        folder,
        "blocks",
    )
    keyed = keyed.drop("doc")
    # What is counted is written before it is joined: then Spark can split a seed or content that is very common.
    index = blocks.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
    index = _written(index.where("n > 1").select("seed", (F.col("low") == F.col("high")).alias("whole")), folder, "index")
    hits = _written(blocks.join(index, "seed"), folder, "hits")
    place = F.struct(*keys, "block", "first", "doc")
    contents = hits.groupBy("seed", "content").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("low"), F.max(place).alias("high"))
    judged = hits.join(_written(contents, folder, "contents"), ["seed", "content"])
    # Seeds in unequal blocks: one of each content stands for its windows.
    first = (F.struct(*keys, "block") == F.struct("low.k1", "low.k2", "low.block")) | (F.col("n") == 1)
    found = _written(
        judged.groupBy(*keys).agg(
            F.collect_list(F.when(F.col("n") > 1, F.struct("block", *_others()))).alias("copies"),
            F.collect_set(F.when(~F.col("whole") & first, F.col("block"))).alias("edges"),
        ),
        folder,
        "found",
    )
    # Both joins with the texts ask for the same columns, so that the texts are shuffled once.
    edges = found.where(F.size("edges") > 0).select(*keys, "edges")
    windows = keyed.join(edges.hint("merge"), keys).mapInArrow(
        _emit_windows(window, seed), "k1 bigint, k2 int, at int, h1 bigint, h2 int"
    )
    common = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    checked = windows.join(common.hint("merge"), ["h1", "h2"]).groupBy(*keys).agg(F.collect_set("at").alias("checked"))
    told = T.ArrayType(
        T.StructType([*T.StructType.fromDDL("first int, end int").fields, T.StructField("doc", doc.dataType), T.StructField("doc_first", T.IntegerType())])
    )
    kind = T.StructType([keyed.schema["row"], *T.StructType.fromDDL(_RESULT).fields, T.StructField("factors", told)])
    return (
        keyed.join(found.select(*keys, "copies").hint("merge"), keys, "left")
        .join(checked.hint("merge"), keys, "left")
        .select("row", "text", "copies", "checked")
        .mapInArrow(_apply(window, seed, digest), kind)
    )


def _others():
    """The references of a block: the least and greatest place of its content, or twice the other one if it is one itself."""
    own, low, high = (F.struct(f"{p}k1", f"{p}k2", f"{p}block") for p in ("", "low.", "high."))
    return [
        F.when(own == low, F.col("high")).otherwise(F.col("low")).alias("low"),
        F.when(own == high, F.col("low")).otherwise(F.col("high")).alias("high"),
    ]


def substring_digests(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of each document."""
    parsed = parse(documents, ["doc_id"], digest=True)
    return parsed.select("row.columns.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def drop_repeated(documents: DataFrame) -> DataFrame:
    """The documents with duplicate spans cut out of ``text``; all columns stay.

    A null text stays null; a text that is all duplicates becomes empty.
    """
    columns = documents.columns
    parsed = parse(documents, columns)
    return parsed.select(*[F.col("kept").alias("text") if c == "text" else F.col("row.columns")[c].alias(c) for c in columns])
