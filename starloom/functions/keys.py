"""Surrogate keys that stay the same from run to run."""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def hash_key(*columns) -> Column:
    """64-bit key of the natural key."""
    return F.xxhash64(*columns)


def add_dense_keys(df: DataFrame, keys, name="key", start=1, bucket_rows=200_000) -> DataFrame:
    """Number the rows ``start, start+1, ...`` without one global sort.

    ``keys`` must be unique. Keys are numbered inside hash buckets of about
    ``bucket_rows`` rows; the bucket sizes, summed in two levels, give each
    bucket its offset. Only key columns are sorted, the rows are joined to their
    numbers. The numbers depend only on the set of keys. The rows are counted
    here and now.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    named = [f"_key{i}" for i in range(len(keys))]
    only = df.select(*[F.col(k).alias(n) for k, n in zip(keys, named)])
    buckets = max(1, -(-df.count() // bucket_rows))
    # Groups of about as many buckets as there are groups: neither window holds more than the root of their number.
    groups = max(1, math.isqrt(buckets))
    only = only.withColumn("_bucket", F.pmod(F.xxhash64(*named), F.lit(buckets)))
    sizes = only.groupBy("_bucket").agg(F.count("*").alias("_size"))
    sizes = sizes.withColumn("_group", F.floor(F.col("_bucket") / (buckets // groups)))
    whole = sizes.groupBy("_group").agg(F.sum("_size").alias("_all"))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select("_group", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_start"))
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    offsets = inside.join(starts, "_group").select("_bucket", (F.col("_start") + F.col("_before")).alias("_offset"))
    in_bucket = Window.partitionBy("_bucket").orderBy(*named)
    numbered = only.withColumn("_row", F.row_number().over(in_bucket)).join(offsets, "_bucket")
    number = (F.col("_offset") + F.col("_row") + (start - 1)).cast("long").alias(name)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named)]
    return df.join(numbered.select(*named, number), reduce(lambda a, b: a & b, same)).drop(*named)
