"""Words of a text and their 64-bit hashes.

A word is a run of bytes other than space and the controls 9 to 13, that is
``[^\\x20\\x09-\\x0D]+``; ``bytes.split`` cuts at exactly these six bytes.
"""

import numpy as np
import pyarrow as pa
import xxhash

_KNOWN_LIMIT = 300_000
_SLICE = 500


def split_words(text):
    """UTF-8 words of a text; none for a null."""
    return [] if text is None else text.encode("utf-8").split()


class WordHasher(dict):
    """Word -> 64-bit hash. Remembers a bounded number of words, the first ones, among them all frequent ones."""

    def __missing__(self, word):
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _KNOWN_LIMIT:
            self[word] = value
        return value

    def hashes(self, words):
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values):
    """Scramble 64-bit values (a bijection), so that sums of products spread well."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def ngram_hashes(words, n, seed=0x9E3779B97F4A7C15):
    """Hash of each run of ``n`` consecutive word hashes: a polynomial in an odd base, scrambled."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    base = np.uint64(seed | 1)
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total = total * base + words[i : i + count]
        return mix(total)


def slices(batches):
    """Arrow batches in pieces of a bounded number of rows, so that what is made of one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE):
            yield batch.slice(start, _SLICE)
    # Workers live on for other tasks: what this one no longer needs goes back.
    pa.default_memory_pool().release_unused()


_CHUNK = 1 << 20
_RANDOM = np.random.default_rng(20)
#: Bytes of one word and their neighbours: A to Z lower case, all separators a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b for b in range(256))
#: All separators a space, other bytes unchanged.
UNCHANGED = bytes(0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b for b in range(256))
_VALUES = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE = 0xD1342543DE82EF95
_POWERS = []


def _powers():
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _POWERS:
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(_CHUNK, base, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS


def _chunk_hashes(chunk):
    """Hashes and starts of the words of at most ``_CHUNK`` folded bytes: polynomials by prefix sums."""
    data = np.frombuffer(chunk, np.uint8)
    powers, inverse = _powers()
    inside = np.concatenate(([False], data != 0x20, [False]))
    starts, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:])
    with np.errstate(over="ignore"):
        values = _VALUES[data] * powers[: len(data)]
        sums = np.cumsum(values, dtype=np.uint64)
        total = (sums[ends] - sums[starts] + values[starts]) * inverse[starts]
        return mix(total + (ends - starts).astype(np.uint64) * np.uint64(_BASE)), starts


def folded_word_hashes(folded):
    """64-bit hashes and starts of the words of folded bytes; words over ``_CHUNK`` bytes are hashed by themselves."""
    hashes, starts, low = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while low < len(folded):
        high = len(folded)
        if high - low > _CHUNK:
            high = folded.rfind(b" ", low, low + _CHUNK + 1)
        if high < 0:
            high = folded.find(b" ", low + _CHUNK)
            high = len(folded) if high < 0 else high
            hashes.append(np.array([xxhash.xxh3_64_intdigest(folded[low:high])], np.uint64))
            starts.append(np.array([low]))
        elif high > low:
            found, at = _chunk_hashes(folded[low:high])
            hashes.append(found)
            starts.append(at + low)
        low = high + 1
    return np.concatenate(hashes), np.concatenate(starts)


def text_word_hashes(texts, table=_FOLD):
    """For texts as UTF-8 bytes (or None): hashes of all words and the bounds of each text's words.

    ``table`` takes A to Z as lower case, or leaves words ``UNCHANGED``.
    """
    texts = [t or b"" for t in texts]
    hashes, starts = folded_word_hashes(b" ".join(texts).translate(table))
    ends = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return hashes, np.searchsorted(starts, ends)


def byte_slices(column, most=4 << 20):
    """Texts of an Arrow column as lists of UTF-8 bytes, of a bounded size together or a single one."""
    texts, size = [], 0
    for text in column.cast(pa.binary()):
        texts.append(text.as_py())
        size += len(texts[-1] or b"")
        if size > most:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts
