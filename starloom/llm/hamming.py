"""Exact top-k search in binary codes by incremental multi-index hashing.

A vector becomes the code of its signs, in segments of 16 bits. The codes are
dealt by hash to blocks; a task holds one block, indexed by the value of every
segment, and the queries stream past it. For a query the search radius grows
segment by segment: after the segments up to ``j`` were searched to radius ``r``
and the others to ``r - 1``, every code within distance ``m * r + j`` has been
found. The search of a block ends when the k-th verified distance is covered by
that bound, so no closer code can be missing. The best of all blocks are merged.

Equal codes are one entry with its ``k`` smallest ids: no more can be among the
nearest. Memory is bounded by a block.

Defined results: neighbours are ordered by distance, then id; a query is its own
neighbour if it is among the rows; rows with a null id or vector or an empty
vector, or a vector with a null or NaN component, take no part; vectors of
different length are never compared; with fewer than ``k`` rows all are
returned. Repeated rows count once for each repetition, repeated queries are one;
a query id names one vector (several would share one list). Extra columns are
not read.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Codes in a block, and queries that stream past a block in one task: at most, and at least if tasks would be idle.
BLOCK_ROWS = 200_000
CHUNK_QUERIES = 100_000
LEAST_QUERIES = 500
_BITS = 16
_VALUES = np.arange(1 << _BITS, dtype=np.uint16)
#: Differences of a segment by their number of bits.
_RINGS = [_VALUES[np.bitwise_count(_VALUES) == r] for r in range(_BITS + 1)]


def sign_code(vector):
    """Signs of a vector (1: not negative) as bytes, padded to whole segments; None without a code."""
    if not vector or any(v is None or v != v for v in vector):
        return None
    bits = np.zeros(-(-len(vector) // _BITS) * _BITS, np.uint8)
    bits[: len(vector)] = np.asarray(vector) >= 0
    return np.packbits(bits).tobytes()


def _codes(batches):
    for batch in batches:
        vectors = batch.column(1).to_pylist()
        codes = pa.array([sign_code(v) for v in vectors], pa.binary())
        bits = pa.array([len(v or ()) for v in vectors], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), codes, bits], ["id", "code", "bits"])


class CodeIndex:
    """Codes of one length, indexed by the values of their segments."""

    def __init__(self, codes, ids):
        """``codes``: distinct bytes; ``ids``: for each its sorted ids."""
        self.ids = ids
        self.codes = np.frombuffer(b"".join(codes), np.uint16).reshape(len(codes), -1)
        self.orders, self.starts = [], []
        for segment in self.codes.T:
            self.orders.append(np.argsort(segment, kind="stable"))
            self.starts.append(np.concatenate(([0], np.bincount(segment, minlength=1 << _BITS).cumsum())))
        self.seen = np.zeros(len(codes), np.int64)
        self.turn = 0

    def nearest(self, code, k):
        """The ``k`` nearest as ``(distance, id)``, exact and in order."""
        query = np.frombuffer(code, np.uint16)
        segments = len(query)
        self.turn += 1
        best = []  # a heap of the k best, the worst first
        for radius in range(_BITS + 1):
            for j in range(segments):
                values = query[j] ^ _RINGS[radius]
                first, end = self.starts[j][values], self.starts[j][values.astype(np.int64) + 1]
                size = end - first
                some = size > 0
                first, size = first[some], size[some]
                if len(size):
                    at = np.repeat(first - np.concatenate(([0], size.cumsum()[:-1])), size) + np.arange(size.sum())
                    rows = self.orders[j][at]
                    rows = rows[self.seen[rows] != self.turn]
                    self.seen[rows] = self.turn
                    far = np.bitwise_count(self.codes[rows] ^ query).sum(1, dtype=np.int64)
                    if len(best) == k:
                        near = far <= -best[0][0]
                        rows, far = rows[near], far[near]
                    for distance, row in zip(far.tolist(), rows.tolist()):
                        for name in self.ids[row]:
                            entry = (-distance, -name)
                            if len(best) < k:
                                heapq.heappush(best, entry)
                            elif entry > best[0]:
                                heapq.heapreplace(best, entry)
                if len(best) == k and -best[0][0] <= segments * radius + j:
                    return sorted((-d, -n) for d, n in best)
        return sorted((-d, -n) for d, n in best)


def _search(k):
    """Rows sorted by block and chunk with the indexed codes first -> nearest of the block for each query."""

    def search(batches):
        key, codes, ids, index = None, [], [], None
        for batch in batches:
            queries, found, distances = [], [], []
            rows = zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in _PLACED])
            for bits, block, chunk, role, code, names in rows:
                if (bits, block, chunk) != key:
                    key, codes, ids, index = (bits, block, chunk), [], [], None
                if role == 0:
                    codes.append(code)
                    ids.append(sorted(names))
                elif codes:
                    index = index or CodeIndex(codes, ids)
                    for distance, name in index.nearest(code, k):
                        queries.append(names[0])
                        found.append(name)
                        distances.append(distance)
            columns = [pa.array(queries, pa.int64()), pa.array(found, pa.int64()), pa.array(distances, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "id", "distance"])

    return search


_PLACED = ["bits", "block", "chunk", "role", "code", "ids"]


def nearest_codes(vectors: DataFrame, queries: DataFrame, k=10, block_rows=BLOCK_ROWS) -> DataFrame:
    """``query_id, id, distance, rank`` of the ``k`` nearest of ``vectors`` for each of ``queries``.

    Both have the columns ``id`` (integer) and ``vector``.
    """

    def coded(df):
        schema = "id bigint, code binary, bits int"
        named = df.select(F.col("id").cast("bigint").alias("id"), "vector")
        return named.mapInArrow(_codes, schema).where("id is not null and code is not null")

    first = Window.partitionBy("bits", "code").orderBy("id")
    few = coded(vectors).withColumn("n", F.row_number().over(first)).where(F.col("n") <= k)
    entries = few.groupBy("bits", "code").agg(F.collect_list("id").alias("ids"))
    asked = coded(queries).dropDuplicates(["id", "bits", "code"])
    blocks = max(1, -(-vectors.count() // block_rows))
    number = queries.count()
    idle = vectors.sparkSession.sparkContext.defaultParallelism // blocks
    chunks = max(1, -(-number // CHUNK_QUERIES), min(idle, number // LEAST_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int")
    base = entries.select("bits", block.alias("block"), every(chunks).alias("chunk"), F.lit(0).alias("role"), "code", "ids")
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")
    stream = asked.select(
        "bits", every(blocks).alias("block"), chunk.alias("chunk"), F.lit(1).alias("role"), "code", F.array("id").alias("ids")
    )
    placed = base.union(stream).select(*_PLACED).repartition("bits", "block", "chunk")
    local = placed.sortWithinPartitions("bits", "block", "chunk", "role").mapInArrow(
        _search(k), "query_id bigint, id bigint, distance int"
    )
    best = Window.partitionBy("query_id").orderBy("distance", "id")
    return local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
