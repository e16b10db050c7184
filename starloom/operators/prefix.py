"""Distributed running sums.

A window over one key puts all rows of that key into one task. Here the rows
are range-partitioned once by key and order, so a key with many rows fills many
partitions, and written. Each partition sums its rows per key; what a key's
earlier partitions add reaches a later one as a single carried row in front of
its own. Partitions follow the rows, not a fixed number of pieces, and rows
that are equal in key and order stay in one partition.
"""

from pyspark.sql import DataFrame, Window, functions as F

from starloom.session import work_folder

#: The partition of a placed row.
PART = "_part"


def place(df: DataFrame, keys, order) -> DataFrame:
    """``df`` range-partitioned by ``keys`` and ``order``, written and read back, with its partition's number.

    Partition numbers rise with ``keys`` and ``order``.
    """
    path = work_folder(df.sparkSession, "placed")
    placed = df.repartitionByRange(*keys, *order).withColumn(PART, F.spark_partition_id())
    placed.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def carried_sums(placed: DataFrame, keys, names) -> DataFrame:
    """``keys``, partition and the sums of a key's earlier partitions, for partitions that have any."""
    totals = placed.groupBy(*keys, PART).agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    counted = {"_parts": F.count(PART).over(earlier), **{n: F.sum(n).over(earlier) for n in names}}
    return totals.select(*keys, PART, *[c.alias(n) for n, c in counted.items()]).where("_parts > 0").drop("_parts")


def running_sums(df: DataFrame, keys, order, sums, frame="rows") -> DataFrame:
    """``df`` with the running sums of ``sums`` (``name -> column``) per ``keys`` in ``order``, the row itself included.

    ``frame="range"`` gives rows that are equal in ``order`` the same sum;
    ``frame="rows"`` counts them one after another. NULL values add nothing, and
    NULL keys are one key. ``df`` is read once for the sample of the range
    partitioning and once for the rows.
    """
    if frame not in ("range", "rows"):
        raise ValueError("frame is 'range' or 'rows'")
    names = {f"_sum{i}": name for i, name in enumerate(sums)}
    columns = df.columns
    marked = df.withColumns({inner: sums[name] for inner, name in names.items()})
    placed = place(marked, keys, order)
    carried = carried_sums(placed, keys, names).withColumn("_carried", F.lit(1))
    both = placed.withColumn("_carried", F.lit(0)).unionByName(carried, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, PART).orderBy(F.desc("_carried"), *order)
    between = inside.rangeBetween if frame == "range" else inside.rowsBetween
    inside = between(Window.unboundedPreceding, Window.currentRow)
    summed = both.select("*", *[F.sum(inner).over(inside).alias(f"_to{inner}") for inner in names])
    results = [F.coalesce(f"_to{inner}", F.lit(0).cast(placed.schema[inner].dataType)).alias(name) for inner, name in names.items()]
    return summed.where("_carried = 0").select(*[f"`{c}`" for c in columns if c not in sums], *results)
