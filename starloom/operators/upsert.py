"""Keyed loads: insert-or-ignore, insert-or-update, last write wins, query tables.

All take the target and the new rows as DataFrames and return the next state
of the target; ``operators.writes`` stores it. Both sides are cut to one row
per key before they meet, so no key is heavy in the join.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starloom.operators.clean import first_per_key, last_per_key


def insert_ignore(target: DataFrame, new: DataFrame, keys, order_by) -> DataFrame:
    """Add the first new row of each key the target does not have."""
    fresh = first_per_key(new.select(*target.columns, *_extra(order_by, target)), keys, order_by)
    known = target.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return target.unionByName(fresh.select(*target.columns).join(known, _same(keys), "left_anti"))


def upsert(target: DataFrame, new: DataFrame, keys, update_cols, order_by) -> DataFrame:
    """Insert new keys; for known ones set ``update_cols`` and keep the rest.

    The new rows act in the order ``order_by``: an inserted row takes
    ``update_cols`` from the last new row and the other columns from the first.
    """
    others = [c for c in target.columns if c not in keys and c not in update_cols]
    place = F.struct(*order_by)
    aggregates = [F.max_by(F.struct(*update_cols), place).alias("_last")]
    if others:
        aggregates.append(F.min_by(F.struct(*others), place).alias("_first"))
    batch = new.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*aggregates).withColumn("_new", F.lit(True))
    both = target.withColumn("_known", F.lit(True)).join(batch, _same(keys), "full_outer")
    columns = {k: F.when(F.col("_known"), F.col(k)).otherwise(F.col(f"_{k}")) for k in keys}
    columns |= {c: F.when(F.col("_new"), F.col(f"_last.{c}")).otherwise(F.col(c)) for c in update_cols}
    columns |= {c: F.when(F.col("_known"), F.col(c)).otherwise(F.col(f"_first.{c}")) for c in others}
    return both.select(*[columns[c].alias(c) for c in target.columns])


def last_write(df: DataFrame, keys, order_by) -> DataFrame:
    """The last row of each key: later rows overwrite earlier ones."""
    return last_per_key(df, keys, order_by)


def build_query_table(df: DataFrame, partition_cols, clustering_cols, cols, order_by=None) -> DataFrame:
    """A table laid out for one query: one row per key, ordered by the clustering columns inside a partition key.

    The rows are range-partitioned over both kinds of columns, so a large
    partition key is spread over several ordered files.
    """
    keys = [*partition_cols, *clustering_cols]
    if order_by:
        df = last_write(df, keys, order_by)
    wanted = [*keys, *[c for c in cols if c not in keys]]
    return df.select(*wanted).repartitionByRange(*keys).sortWithinPartitions(*keys)


def _same(keys):
    """Equal keys; a NULL is a value like others, so a repeated load adds nothing."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def _extra(order_by, target) -> list:
    return [c for c in order_by if isinstance(c, str) and c not in target.columns]
