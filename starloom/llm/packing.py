"""Packing: optimal length buckets, and token-budget batches inside each bucket.

Documents are cut into pieces of at most ``max_length`` tokens, so the global
histogram of piece lengths has at most that many entries and is the only thing
the driver sees. Dynamic programming over it chooses the bucket boundaries with
the least padding. Inside a bucket with boundary ``b`` every batch has
``budget // b`` pieces (at least one), the last one fewer.

Pieces are numbered in two levels: a bucket is dealt by hash to shards of about
``SHARD_ROWS`` pieces, numbered inside a shard, and moved up by the sizes of the
shards before. A hot bucket is thus many tasks, and batches run on across shards.
Lengths are counted once and written, with a number for each row, so that rows
that repeat an id (or have none) are dealt to different shards.

Defined results: documents without tokens (also null) have one row with
``n_tokens`` 0 and no bucket or batch. Repeated rows are packed one by one;
equal pieces are interchangeable. Only the id and the length are read.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import work_folder

MAX_LENGTH = 2048
BUCKETS = 16
#: Padded tokens in a batch.
BUDGET = 65_536
SHARD_ROWS = 50_000


def word_tokens(text: Column) -> Column:
    """Tokens of a text, counted as words ``[^\\x20\\x09-\\x0D]+``."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def best_boundaries(histogram, buckets=BUCKETS):
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``histogram`` maps length to count. ``cost[k][j]`` is the least padding of
    the first ``j`` lengths in ``k`` buckets; a bucket pads to its longest length.
    """
    lengths = np.array(sorted(histogram), np.float64)
    counts = np.array([histogram[int(v)] for v in lengths], np.float64)
    if not len(lengths):
        return []
    n = np.concatenate(([0.0], counts.cumsum()))
    total = np.concatenate(([0.0], (counts * lengths).cumsum()))
    size = len(lengths)
    cost = np.full(size + 1, np.inf)
    cost[0] = 0.0
    cuts = []
    for _ in range(min(buckets, size)):
        after, cut = np.full(size + 1, np.inf), np.zeros(size + 1, np.int64)
        after[0] = 0.0
        for j in range(1, size + 1):
            choice = cost[:j] + lengths[j - 1] * (n[j] - n[:j]) - (total[j] - total[:j])
            cut[j] = choice.argmin()
            after[j] = choice[cut[j]]
        cuts.append(cut)
        cost = after
    bounds, j = [], size
    for cut in reversed(cuts):
        if j:
            bounds.append(int(lengths[j - 1]))
            j = int(cut[j])
    return bounds[::-1]


def pack(documents: DataFrame, tokens: Column, max_length=MAX_LENGTH, buckets=BUCKETS, budget=BUDGET) -> DataFrame:
    """``doc_id, piece, first_token, n_tokens, bucket, batch`` of every piece.

    ``bucket`` is the padded length, ``batch`` counts from 0 in each bucket.
    """
    whole = F.lit(max_length).cast("bigint")
    folder = work_folder(documents.sparkSession, "packing")
    documents.select("doc_id", tokens.alias("total"), F.monotonically_increasing_id().alias("row")).write.parquet(folder)
    counted = documents.sparkSession.read.parquet(folder)
    last = F.when(F.col("total") > 0, F.floor((F.col("total") - 1) / whole))
    pieces = counted.select("doc_id", "total", "row", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    first = F.coalesce(F.col("piece") * whole, F.lit(0))
    pieces = pieces.select(
        "doc_id",
        F.coalesce("piece", F.lit(0)).alias("piece"),
        first.alias("first_token"),
        F.least(F.col("total") - first, whole).alias("n_tokens"),
        "row",
    )
    histogram = {r["n_tokens"]: r["count"] for r in pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()}
    bounds = best_boundaries(histogram, buckets)
    if not bounds:
        return pieces.drop("row").select("*", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("bigint").alias("batch"))
    sizes = [sum(c for v, c in histogram.items() if low < v <= b) for low, b in zip([0, *bounds], bounds)]
    shards = [-(-s // SHARD_ROWS) for s in sizes]

    def by_bucket(values):
        chosen = F.lit(None).cast("bigint")
        for b, value in reversed(list(zip(bounds, values))):
            chosen = F.when(F.col("n_tokens") <= b, F.lit(value).cast("bigint")).otherwise(chosen)
        return F.when(F.col("n_tokens") > 0, chosen)

    spread = F.xxhash64("row", "piece")
    dealt = pieces.select("*", by_bucket(bounds).alias("bucket"), F.pmod(spread, by_bucket(shards)).alias("shard"))
    packed, empty = dealt.where("bucket is not null"), dealt.where("bucket is null")
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        packed.groupBy("bucket", "shard")
        .count()
        .select("bucket", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("bucket", "shard").orderBy(spread, "row", "piece")
    number = F.row_number().over(inside) - 1
    packed = packed.withColumn("number", number).join(offsets, ["bucket", "shard"])
    batch = F.floor((F.col("number") + F.col("offset")) / by_bucket([max(1, budget // b) for b in bounds]))
    columns = ["doc_id", "piece", "first_token", "n_tokens", "bucket"]
    return packed.select(*columns, batch.alias("batch")).union(empty.select(*columns, F.lit(None).cast("bigint")))
