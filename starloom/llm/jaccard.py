"""N-gram Jaccard join: universe-partition pigeonhole with one-deletion neighbourhoods.

The set of a text holds the hashes of its distinct 3-word shingles. Two sets
link when ``100 * intersection >= LEAST * union``.

*Size bands.* Bands are wide enough that linked sets lie in the same or in
adjacent bands. Scheme ``k`` serves the pairs whose larger set is in band ``k``;
a set is entered in the scheme of its band, and in the next one if it is large
enough to link into it. In a scheme the symmetric difference of linked sets is
at most ``H``.

*Segments.* A scheme deals all shingles to segments by hash. A segment matched
as a whole absorbs one difference; cut into parts, of which all subsets but
``k`` parts are indexed, it absorbs ``k + 1``; matched also by its one-deletion
neighbourhood it absorbs two. When the segments together absorb more than ``H``,
linked sets agree in a signature. Which kinds a scheme takes is chosen by
cost: signatures to index against the pairs expected to meet by chance, given
the number of sets in the band.

*Signatures* are made once. Of those that meet inside a batch of a task, all
but one stay there; the rest goes, in packed bytes, to the bucket of its hash,
where one task keeps one holder of each signature and passes on the signatures
that have others.

*Links.* Sets that share a signature are candidates and are verified exactly.
First each signature's members meet one centre, the member with most shared
signatures; links are closed to components; then, only where a signature's
members still lie in several components, all their pairs across components are
verified. Pairs inside a component are never emitted, equal sets are one node,
and no group is collected.

Shingles and sets are compared by 64-bit hashes.

Defined results: texts without words and null texts have no shingles and link
with nothing, their component is their own id; texts of one or two words have
the whole sequence as one shingle; equal texts link. Rows with a null
``doc_id`` link and can join others, but never name a component: the smallest id
that is not null does, or null if there is none.
"""

from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import byte_slices, mix, ngram_hashes, slices, text_word_hashes
from starloom.session import work_folder

SHINGLE = 3
#: Least similarity, in hundredths.
LEAST = 90
#: Signatures of a batch that meet before the shuffle or in a bucket at a time, and distinct ones in a bucket, about.
BATCH_SIGNATURES, BUCKET_SIGNATURES = 1 << 18, 1 << 21


def shingle_sets(texts, size=SHINGLE):
    """Sorted hashes of the distinct shingles of each text (UTF-8 bytes or None, A to Z taken as lower case)."""
    hashes, bounds = text_word_hashes(texts)
    grams = ngram_hashes(hashes, size)
    sets = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if start == end:
            sets.append(np.zeros(0, np.uint64))
        elif end - start < size:
            sets.append(ngram_hashes(hashes[start:end], end - start, 0xA0761D6478BD642F + 2 * (end - start)))
        else:
            found = np.sort(grams[start : end - size + 1])
            sets.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
    return sets


def set_id(shingles):
    """64-bit id of a set."""
    with np.errstate(over="ignore"):
        total = mix(shingles + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
        return int(mix(np.array([total + np.uint64(len(shingles))]))[0].view(np.int64))


class Bands:
    """Size bands. A set enters the scheme of its band, and that of the next band if it can link into it."""

    def __init__(self, least=LEAST, growth=1.4):
        self.least = least
        self.lows = [1]
        growth = max(growth, 100 / least)
        while self.lows[-1] < 2**31:
            self.lows.append(max(self.lows[-1] + 1, int(np.ceil(self.lows[-1] * growth))))

    def of(self, size):
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def schemes(self, size):
        band = self.of(size)
        return [band, band + 1] if 100 * size >= self.least * self.lows[band + 1] else [band]

    def top(self, scheme):
        return self.lows[scheme + 1] - 1

    def differences(self, scheme):
        """Largest symmetric difference of linked sets whose larger one is in the band."""
        return 2 * self.top(scheme) * (100 - self.least) // (100 + self.least)

    def column(self, size):
        return F.size(F.filter(F.array(*map(F.lit, self.lows)), lambda low: low <= size)) - 1


class Plan(NamedTuple):
    """Kinds of segments: ``groups`` cut into ``parts``, of which ``spare`` may differ, and ``deleted`` with neighbourhoods."""

    groups: int
    parts: int
    spare: int
    deleted: int

    def absorbs(self):
        return self.groups * (self.spare + 1) + 2 * self.deleted


_KINDS = [(1, 0), *[(n, 1) for n in range(3, 8)], *[(n, 2) for n in range(4, 8)], *[(n, 3) for n in range(5, 9)]]


def costs(top, differences, sets):
    """For every choice of segments: ``(signatures, pairs by chance, plans)`` for ``sets`` sets of up to ``top`` shingles.

    Unrelated sets meet where what is matched is empty in both, or one
    shingle next to none in neighbourhoods.
    """
    deleted = np.arange((differences + 1) // 2 + 1)
    for parts, spare in _KINDS:
        groups = -(-np.maximum(0, differences + 1 - 2 * deleted) // (spare + 1))
        load = top / (groups + deleted)
        indexed = groups * comb(parts, spare)
        rows = indexed + deleted * (1 + load)
        matched = load * (parts - spare) / parts
        pairs = sets / 2 * (indexed * np.exp(-2 * matched) + deleted * np.exp(-2 * load) * (1 + 2 * load))
        for choice in zip(rows.tolist(), pairs.tolist(), groups.tolist(), deleted.tolist()):
            yield choice[0], choice[1], Plan(choice[2], parts, spare, choice[3])


def allocate(top, differences, sets):
    """The cheapest choice: signatures count one, a pair its sketches, as few unrelated sets meet whole."""
    pair = min(max(1.0, top / 4), 64 + top / 64)
    return min(costs(top, differences, sets), key=lambda c: (c[0] + c[1] * pair, c[2]))[2]


def expected_signatures(plan, top):
    return plan.groups * comb(plan.parts, plan.spare) + plan.deleted * (1 + top / (plan.groups + plan.deleted))


def signatures(shingles, scheme, plan):
    """Signatures of a set in one scheme, and which of them are deletions."""
    groups, parts, spare, deleted = plan
    spread = mix(shingles ^ np.uint64(0x2545F4914F6CDD1D))
    region = ((spread >> np.uint64(32)) % np.uint64(groups + deleted)).astype(np.int64)
    part = (spread % np.uint64(parts)).astype(np.int64)
    cell = np.where(region < groups, region * parts + part, groups * (parts - 1) + region)
    order = np.argsort(cell, kind="stable")
    cell, value = cell[order], mix(spread[order])
    bounds = np.searchsorted(cell, np.arange(groups * parts + deleted + 1))
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
        total = sums[bounds[1:]] - sums[bounds[:-1]]
        count = np.diff(bounds).astype(np.uint64)
        subsets = np.array(list(combinations(range(parts), parts - spare)))
        cut = total[: groups * parts].reshape(groups, parts)[:, subsets].sum(2, dtype=np.uint64).ravel()
        cut_count = count[: groups * parts].reshape(groups, parts)[:, subsets].sum(2, dtype=np.uint64).ravel()
        number = np.arange(len(cut) + deleted, dtype=np.uint64)
        label = mix(((np.uint64(scheme) << np.uint64(32)) + number) * np.uint64(_LABEL) + np.uint64(1))
        total, count = np.concatenate((cut, total[groups * parts :])), np.concatenate((cut_count, count[groups * parts :]))
        full = mix(mix(total + label) + count)
        if not deleted:
            return full, np.zeros(len(full), bool)
        inside = cell >= groups * parts
        of = cell[inside] - groups * parts + len(cut)
        less = mix(mix(total[of] - value[inside] + label[of]) + count[of] - np.uint64(1))
    return np.concatenate((full, less)), np.concatenate((np.zeros(len(full), bool), np.ones(len(less), bool)))


_LABEL = 0xD1342543DE82EF95


def _described(batches, size):
    """Rows of a bounded number of bytes with their shingle sets."""
    for batch in slices(batches):
        start = 0
        for texts in byte_slices(batch.column(batch.schema.get_field_index("text"))):
            yield batch.slice(start, len(texts)), shingle_sets(texts, size)
            start += len(texts)


def _describe(size):
    def describe(batches):
        for rows, sets in _described(batches, size):
            nodes = [set_id(s) if len(s) else None for s in sets]
            sketches = (pa.array([f(s) for s in sets], pa.binary()) for f in (sketch, fine_sketch))
            columns = [*rows.columns[:-1], pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *sketches]
            yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names[:-1], "node", "n", "sketch", "fine"])

    return describe


#: Holders of signatures: the signature, the set's id and size, whether it is a deletion.
_HOLDER = np.dtype([("sig", np.uint64), ("node", np.int64), ("n", np.int32), ("deletion", bool)])


def _in_order(holders):
    """Distinct holders by signature, whole matches first, and where a signature's holders begin."""
    sig = np.ascontiguousarray(holders["sig"])
    order = np.argsort(sig)
    sig = sig[order]
    repeated = np.concatenate(([False], sig[1:] == sig[:-1])) if len(sig) else np.zeros(0, bool)
    several = repeated | np.append(repeated[1:], False)
    # Few signatures have several holders: only these are put in order.
    some = holders[order[several]]
    order[several] = order[several][np.lexsort((some["node"], some["deletion"], some["sig"]))]
    holders = holders[order]
    again = repeated.copy()
    again[1:] &= holders["node"][1:] == holders["node"][:-1]
    return holders[~again], np.flatnonzero(~repeated[~again])


def _shared(holders, first):
    """Holders of signatures that two sets or more have."""
    sizes = np.diff(np.append(first, len(holders)))
    low = np.minimum.reduceat(holders["node"], first) if len(first) else np.zeros(0, np.int64)
    high = np.maximum.reduceat(holders["node"], first) if len(first) else np.zeros(0, np.int64)
    return np.repeat(low != high, sizes)


def _pack(holders):
    """Holders of one bucket as bytes: a table of runs of one set, then per holder six bytes of signature and a bit."""
    node = holders["node"]
    first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    lengths = np.diff(np.append(first, len(node))).astype(np.uint32)
    sig = holders["sig"].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    head = np.array([len(first), len(node)], np.uint32)
    return b"".join(x.tobytes() for x in (head, node[first], holders["n"][first], lengths, sig, np.packbits(holders["deletion"])))


def _unpack(payload, bucket):
    runs, count = np.frombuffer(payload, np.uint32, 2).tolist()
    nodes = np.frombuffer(payload, np.int64, runs, 8)
    sizes, lengths = (np.frombuffer(payload, kind, runs, 8 + at * runs) for kind, at in ((np.int32, 8), (np.uint32, 12)))
    at = 8 + 16 * runs
    sig = np.zeros((count, 8), np.uint8)
    sig[:, :6] = np.frombuffer(payload, np.uint8, 6 * count, at).reshape(-1, 6)
    deletion = np.unpackbits(np.frombuffer(payload, np.uint8, -1, at + 6 * count), count=count)
    holders = np.empty(count, _HOLDER)
    # The rest of the signature chose the bucket.
    holders["sig"] = sig.view("<u8")[:, 0] | (np.uint64(bucket & 0xFFFF) << np.uint64(48))
    holders["node"], holders["n"], holders["deletion"] = np.repeat(nodes, lengths), np.repeat(sizes, lengths), deletion
    return holders


def even_keys(spark, parts):
    """A key for each of ``parts`` partitions that Spark's hash deals to it, so that no task gets several buckets."""
    keys = spark.range(32 * parts).select(F.col("id").cast("int").alias("key"))
    found = keys.groupBy(F.pmod(F.hash("key"), F.lit(parts)).alias("part")).agg(F.min("key").alias("key")).collect()
    named = {r["part"]: r["key"] for r in found}
    return [named.get(p, p) for p in range(parts)]


def _emit_signatures(size, bands, plan, keys):
    """Texts -> packed holders per bucket: ``met`` ones have met another in their batch, of all others there is one each."""
    buckets, keys = len(keys), np.array(keys)

    def packed(found):
        holders, first = _in_order(np.concatenate(found))
        shared = _shared(holders, first)
        rows = []
        for met, some in ((True, holders[shared]), (False, holders[first])):
            bucket = ((some["sig"] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            # Sets in runs: they are packed as one entry each.
            order = np.lexsort((some["node"], bucket))
            names, starts = np.unique(bucket[order], return_index=True)
            rows += [(int(keys[b]), met, _pack(some[order[s:e]])) for b, s, e in zip(names, starts, np.append(starts[1:], len(some)))]
        columns = zip(zip(*rows), (pa.int32(), pa.bool_(), pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in columns], ["bucket", "met", "holders"])

    def emit(batches):
        found, total, sets_held = [], 0, 0
        for _, sets in _described(batches, size):
            for shingles in sets:
                if not len(shingles):
                    continue
                name = set_id(shingles)
                for scheme in bands.schemes(len(shingles)):
                    if scheme in plan:
                        sig, deletion = signatures(shingles, scheme, plan[scheme])
                        holders = np.empty(len(sig), _HOLDER)
                        holders["sig"], holders["deletion"] = sig, deletion
                        holders["node"], holders["n"] = name, len(shingles)
                        found.append(holders)
                        total += len(sig)
                sets_held += 1
                if total >= BATCH_SIGNATURES or sets_held == 1 << 15:
                    if found:
                        yield packed(found)
                    found, total, sets_held = [], 0, 0
        if found:
            yield packed(found)

    return emit


def _match(batches):
    """Packed holders of whole buckets -> holders of shared signatures.

    One holder of each signature is kept; a later one of another set makes it shared.
    """

    def rows(holders):
        columns = [pa.array(holders["sig"].view(np.int64)), *[pa.array(np.ascontiguousarray(holders[c])) for c in ("node", "n", "deletion")]]
        return pa.RecordBatch.from_arrays(columns, ["sig", "node", "n", "deletion"])

    known, waiting, size = np.empty(0, _HOLDER), [], 0

    def settle():
        nonlocal known, waiting, size
        waiting.append(known)
        known = np.concatenate(waiting)
        waiting, size = [], 0
        holders, first = _in_order(known)
        known = holders[first]
        return rows(holders[_shared(holders, first)])

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in ("bucket", "met", "holders")]
        for bucket, met, payload in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2]):
            holders = _unpack(payload.as_buffer(), bucket)
            if met:
                yield rows(holders)
            else:
                waiting.append(holders)
                size += len(holders)
                if size >= max(BATCH_SIGNATURES, BUCKET_SIGNATURES // 4):
                    yield settle()
    if waiting:
        yield settle()


def _emit_sets(size):
    def emit(batches):
        for rows, sets in _described(batches, size):
            right = pa.array([set_id(m) == n.as_py() for m, n in zip(sets, rows.column(0))], pa.bool_())
            members = pa.array([m.tobytes() for m in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column(0), members], ["node", "members"]).filter(right)

    return emit


def sketch(shingles):
    """How many shingles fall in each of 256 classes, up to 255: the difference of two sketches is at most that of the sets."""
    counts = np.bincount((mix(shingles) >> np.uint64(56)).astype(np.int64), minlength=256)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def fine_sketch(shingles):
    """A sketch with a class for eight shingles or fewer; empty where the 256 classes of the other are as fine."""
    bits = max(1, (len(shingles) - 1) // 8).bit_length()
    if bits <= 8:
        return b""
    counts = np.bincount((mix(shingles) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _may_link_finely(one, other, size, other_size, least):
    """Whether two sets can link by their fine sketches: the longer is folded to the classes of the other."""
    classes = min(len(one), len(other))
    if not classes:
        return True
    counts = (np.frombuffer(x, np.uint8).reshape(classes, -1).sum(1, dtype=np.int64) for x in (one, other))
    one, other = (np.minimum(c, 255) for c in counts)
    return bool(_may_link(one, other, size, other_size, least))


def _may_link(one, other, sizes, others, least):
    """Whether sets can link by their sketches (rows of counts that broadcast against each other) and sizes."""
    apart = np.abs(one - other).sum(-1)
    return apart * (100 + least) <= (100 - least) * (sizes + others)


def _counts(column):
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 256).astype(np.int16)


def _sift_pairs(least, fine=False):
    """Pairs with sketches (or fine ones) and sizes -> pairs that can link."""

    def sift(batches):
        for batch in slices(batches):
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("one", "other", "n", "m")]
            keep = np.zeros(0, bool)
            if fine:
                keep = np.array([_may_link_finely(*row, least) for row in zip(*[c.to_pylist() for c in columns])], bool)
            elif batch.num_rows:
                one, other = (_counts(c.to_pylist()) for c in columns[:2])
                keep = _may_link(one, other, columns[2].to_numpy(), columns[3].to_numpy(), least)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sift


_SIFTED = ["family", "block", "chunk", "role", "node", "component"]


def _sift_blocks(least, fine=False):
    """Rows of ``across`` with sketches (or fine ones), held sets first -> those that can link with a set of another component there."""

    def sift(batches):
        key, held, hit, counts = None, [], None, None
        for batch in batches:
            rows = list(zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*_SIFTED, "n", "sketch")]))
            out = []
            for row in rows:
                if row[:3] != key:
                    out += [held[i] for i in np.flatnonzero(hit)] if hit is not None else []
                    key, held, hit = row[:3], [], None
                if row[3] == 0:
                    held.append(row)
                    continue
                if hit is None:
                    hit, counts = np.zeros(len(held), bool), None if fine else _counts([r[7] for r in held])
                    sizes, names = np.array([r[6] for r in held]), np.array([r[5] for r in held])
                near = (names != row[5]) & (100 * np.minimum(sizes, row[6]) >= least * np.maximum(sizes, row[6]))
                near = np.flatnonzero(near)
                if fine:
                    near = [i for i in near if _may_link_finely(held[i][7], row[7], sizes[i], row[6], least)]
                elif len(near):
                    near = near[_may_link(counts[near], _counts([row[7]]), sizes[near], row[6], least)]
                if len(near):
                    hit[near] = True
                    out.append(row)
            yield _sifted(out)
        if hit is not None:
            yield _sifted([held[i] for i in np.flatnonzero(hit)])

    return sift


def _sifted(rows):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], _SIFTED)


def linked(a, b, least=LEAST):
    """Whether two sorted sets link."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= least * (len(both) - common)


def _verify(least):
    def verify(batches):
        for batch in slices(batches):
            keep = np.zeros(batch.num_rows, bool)
            a, b = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                one = np.frombuffer(a[i].as_buffer(), np.uint64)
                keep[i] = linked(one, np.frombuffer(b[i].as_buffer(), np.uint64), least)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return verify


def _written(df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _fingerprint(edges):
    """Number of edges and an exact sum of their hashes."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node, component`` (least node) for the nodes of undirected links ``a, b``.

    Large-star and small-star steps, each an aggregation and a join; the state
    is written after every round, and a round without change ends it.
    """
    edges = _written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), folder, "edges0"
    )
    step, state = 0, None
    while state != (state := _fingerprint(edges)):
        step += 1
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = met.union(least.select("u", F.col("m").alias("v")))
        edges = _written(small.distinct(), folder, f"edges{step}")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _links(pairs, sets, least):
    """The pairs ``a, b`` whose sets link."""
    one = sets.select(F.col("node").alias("a"), F.col("members").alias("one"))
    other = sets.select(F.col("node").alias("b"), F.col("members").alias("other"))
    both = pairs.join(one.hint("merge"), "a").join(other.hint("merge"), "b").select("a", "b", "one", "other")
    return both.mapInArrow(_verify(least), "a bigint, b bigint")


_MEETING = ["family", "block", "chunk", "role", "node", "component", "members"]
#: Sets that are held at once, and sets that stream past them in a task.
_BLOCK, _CHUNK = 256, 50_000


def _meet(hold):
    """Rows sorted by family, block and chunk, the held sets first -> links into other components."""

    def meet(batches):
        key, held, index = None, [], None
        for batch in batches:
            a, b = [], []
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in _MEETING[:-1]]
            members = batch.column(batch.schema.get_field_index("members"))
            for i, (family, block, chunk, role, node, component) in enumerate(zip(*columns)):
                if (family, block, chunk) != key:
                    key, held, index = (family, block, chunk), [], None
                values = np.frombuffer(members[i].as_buffer(), np.uint64)
                if role == 0:
                    held.append((node, component, values.copy()))
                else:
                    index = index or hold(held)
                    for other in index.linked(values, component):
                        a.append(node)
                        b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return meet


class _Held:
    """Inverted index of a block of sets."""

    def __init__(self, held, least):
        self.least = least
        self.node, self.component = ([r[i] for r in held] for i in range(2))
        self.size = np.array([len(r[2]) for r in held])
        values = np.concatenate([r[2] for r in held])
        order = np.argsort(values, kind="stable")
        self.owner = np.repeat(np.arange(len(held)), self.size)[order]
        self.value, self.start = np.unique(values[order], return_index=True)
        self.end = np.concatenate((self.start[1:], [len(values)]))
        self.known = set()

    def linked(self, values, component):
        """Held sets of other components that link with a set; one for each pair of components."""
        at = np.minimum(np.searchsorted(self.value, values), len(self.value) - 1)
        at = at[self.value[at] == values]
        length = self.end[at] - self.start[at]
        places = np.repeat(self.start[at] - np.concatenate(([0], length.cumsum()[:-1])), length) + np.arange(length.sum())
        common = np.bincount(self.owner[places], minlength=len(self.size))
        for i in np.flatnonzero(100 * common >= self.least * (self.size + len(values) - common)):
            pair = component, self.component[i]
            if pair[0] != pair[1] and pair not in self.known:
                self.known.add(pair)
                yield self.node[i]


def across(labelled, sets, hold, folder, nodes=None, sift=None):
    """Links between sets that share a signature and lie in different components.

    ``labelled`` has ``sig, node, component``, ``sets`` has ``node, members``;
    ``hold`` makes the index of a block of ``(node, component, members)``. With
    ``sift``, rows with the size ``n`` and the ``sketch`` of the sets (columns of
    ``nodes``) pass through each of its functions first, by the name of the
    sketch, and only what they leave meets whole: ``sets`` is then a function of
    the nodes needed. Signatures of two sets are done.

    The largest component of a signature names its family. A set outside it is
    held in a block of that family; all members of the signatures of the block's
    sets in this family stream past the block, each once. So a block takes at
    most one row for each member of a signature of its family.
    """
    counts = labelled.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("sig").agg(F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"))
    apart = largest.where("parts > 1 and n > 2").select("sig", F.col("top.component").alias("main"))
    members = _written(labelled.join(apart.hint("merge"), "sig").select("sig", "node", "component", "main"), folder, "apart")
    outside = members.where("component <> main")
    owners = outside.select(F.col("main").alias("family"), "node", "component").distinct()
    blocks = owners.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    held = _written(owners.join(blocks.hint("merge"), "family").select("family", block, "node", "component"), folder, "held")
    touched = outside.select("sig", F.col("main").alias("family"), "node").join(held.drop("component").hint("merge"), ["family", "node"])
    stream = _written(
        touched.select("sig", "family", "block")
        .distinct()
        .join(members.select("sig", "node", "component").hint("merge"), "sig")
        .select("family", "block", "node", "component")
        .distinct(),
        folder,
        "stream",
    )
    place = ["family", "block"]
    chunks = stream.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / _CHUNK).alias("chunks")).hint("merge")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk")
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).alias("chunk")
    first = held.join(chunks, place).select(*place, every, F.lit(0).alias("role"), "node", "component")
    after = stream.join(chunks, place).select(*place, chunk, F.lit(1).alias("role"), "node", "component")
    rows = first.union(after)
    for name, function in (sift or {}).items():
        rows = rows.join(nodes.select("node", "n", F.col(name).alias("sketch")).hint("merge"), "node")
        rows = rows.select(*_SIFTED, "n", "sketch").repartition(*place, "chunk").sortWithinPartitions(*place, "chunk", "role")
        schema = "family bigint, block bigint, chunk bigint, role int, node bigint, component bigint"
        rows = _written(rows.mapInArrow(function, schema), folder, f"sifted_{name}")
    if sift:
        sets = sets(rows.select("node").distinct())
    placed = rows.join(sets.select("node", "members").hint("merge"), "node").select(*_MEETING)
    dealt = placed.repartition(*place, "chunk").sortWithinPartitions(*place, "chunk", "role")
    return dealt.mapInArrow(_meet(hold), "a bigint, b bigint").distinct()


def describe(documents: DataFrame, folder, size=SHINGLE) -> DataFrame:
    """Written table of ``k1, k2`` (key of the row), ``doc_id, node, n`` and the sketches of the set."""
    schema = T.StructType(
        [
            *T.StructType.fromDDL("k1 bigint, k2 int").fields,
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            *T.StructType.fromDDL("node bigint, n bigint, sketch binary, fine binary").fields,
        ]
    )
    return _written(_keyed(documents).mapInArrow(_describe(size), schema), folder, "rows")


def _keyed(documents, *more):
    keys = F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2")
    return documents.select(*keys, *more, "doc_id", "text")


def node_components(documents: DataFrame, rows: DataFrame, folder, least=LEAST, size=SHINGLE) -> DataFrame:
    """``node, component`` of the sets that link with others. ``rows`` comes from ``describe``."""
    bands = Bands(least)
    counts = rows.where("n > 0").groupBy(bands.column(F.col("n")).alias("band")).count().collect()
    there = {r["band"]: r["count"] for r in counts}
    plan = {k: allocate(bands.top(k), bands.differences(k), n + there.get(k - 1, 0)) for k, n in there.items()}
    expected = sum((n + there.get(k - 1, 0)) * expected_signatures(plan[k], bands.top(k)) for k, n in there.items())
    buckets = max(1, int(expected // BUCKET_SIGNATURES))
    spark = documents.sparkSession
    packed = documents.select("text").mapInArrow(
        _emit_signatures(size, bands, plan, even_keys(spark, buckets)), "bucket int, met boolean, holders binary"
    )
    shared = packed.repartition(buckets, "bucket").mapInArrow(_match, "sig bigint, node bigint, n int, deletion boolean")
    met = _written(shared.distinct(), folder, "met")
    if any(p.deleted for p in plan.values()):
        # Two deletions that agree are not a match.
        whole = met.groupBy("sig").agg(F.min("deletion").alias("deletion")).where("not deletion").select("sig")
        met = _written(met.join(_written(whole, folder, "whole"), "sig"), folder, "matched")
    degrees = met.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    described = rows.groupBy("node").agg(F.min(F.struct("k1", "k2", "n", "sketch", "fine")).alias("row"))
    nodes = _written(described.join(degrees.hint("merge"), "node").select("node", "row.*"), folder, "nodes")

    def sets_of(needed, name):
        """Written table of ``node, members`` of the needed nodes, made from one text of each."""
        firsts = nodes.select("node", "k1", "k2").join(needed.hint("merge"), "node")
        texts = _keyed(documents).join(firsts.hint("merge"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
        return _written(texts.select("node", "text").mapInArrow(_emit_sets(size), "node bigint, members binary"), folder, name)

    similar = F.lit(100) * F.least("n", "m") >= F.lit(least) * F.greatest("n", "m")
    centres = (
        met.where("not deletion")
        .join(degrees, "node")
        .groupBy("sig")
        .agg(F.max(F.struct("degree", "node", "n")).alias("centre"))
        .select("sig", F.col("centre.node").alias("to"), F.col("centre.n").alias("m"))
    )
    stars = met.join(centres.hint("merge"), "sig").where((F.col("node") != F.col("to")) & similar)
    ends = F.least("node", "to").alias("a"), F.greatest("node", "to").alias("b")
    near = _written(stars.select(*ends).distinct(), folder, "stars")
    for kind in ("sketch", "fine"):
        one = nodes.select(F.col("node").alias("a"), "n", F.col(kind).alias("one"))
        other = nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col(kind).alias("other"))
        pairs = near.join(one.hint("merge"), "a").join(other.hint("merge"), "b").select("a", "b", "one", "other", "n", "m")
        near = _written(pairs.mapInArrow(_sift_pairs(least, kind == "fine"), "a bigint, b bigint"), folder, f"near_{kind}")
    ends = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).distinct()
    first = components(_links(near, sets_of(ends, "sets"), least), f"{folder}/first")

    labelled = met.join(first.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    sift = {"sketch": _sift_blocks(least), "fine": _sift_blocks(least, fine=True)}
    rest = across(labelled, lambda needed: sets_of(needed, "sets_across"), lambda held: _Held(held, least), folder, nodes, sift)
    found = _written(rest, folder, "across")
    if found.isEmpty():
        return first
    joined = first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(found)
    return components(joined, f"{folder}/second")


def _grouped(documents, least, size):
    folder = work_folder(documents.sparkSession, "jaccard")
    rows = describe(documents, folder, size)
    found = node_components(documents, rows, folder, least, size)
    return rows.join(found.hint("merge"), "node", "left").withColumn("class", F.coalesce("component", "node"))


def near_classes(documents: DataFrame, least=LEAST, size=SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each document; only ``doc_id`` and ``text`` are read."""
    rows = _grouped(documents, least, size)
    names = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("name"))
    named = rows.join(names.hint("merge"), "class", "left")
    return named.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id"),
    )


def keep_first(documents: DataFrame, least=LEAST, size=SHINGLE) -> DataFrame:
    """One document of each class, that with the smallest id, with all columns; texts without words all stay."""
    rows = _grouped(documents, least, size).where("class is not null")
    least_row = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k1", "k2")).alias("row")
    kept = rows.groupBy("class").agg(least_row).select("row.k1", "row.k2")
    columns = documents.columns
    whole = documents.select(
        F.xxhash64("doc_id", "text").alias("k1"),
        F.hash("doc_id", "text").alias("k2"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("has_words"),
    )
    chosen = whole.where("has_words").join(kept.hint("merge"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    return chosen.select("row.*").union(whole.where("not has_words").select("row.*"))
