"""Table layouts that save shuffles and reads."""

from pyspark.sql import DataFrame


#: Bytes of a bucket's rows, about.
BUCKET_BYTES = 32 << 20


def table_bytes(df: DataFrame) -> int:
    """Bytes of the rows when read: their number times Spark's width of their types, or its size estimate if that is more.

    Files hold repeated values in far fewer bytes than tasks do. Counting a Parquet table reads its footers.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(estimate, df.count() * (8 + df._jdf.schema().defaultSize()))


def bucket_count(*tables: DataFrame, bucket_bytes=BUCKET_BYTES) -> int:
    """Buckets for tables that are joined with each other: enough for the largest, as one task sorts a bucket."""
    return max(1, -(-max(map(table_bytes, tables)) // bucket_bytes))


def write_bucketed(df: DataFrame, table: str, buckets: int, *keys, path=None) -> DataFrame:
    """A table bucketed and sorted on its join keys, at ``path`` or in the warehouse.

    Two tables with the same number of buckets on the join key are joined
    without a shuffle. Rows are first brought together by bucket, so a bucket
    is a few files, not one from every task.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def write_sorted(df: DataFrame, path, *columns) -> None:
    """Parquet ordered by the columns, so that row groups can be skipped by their value ranges."""
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def shuffle_count(df: DataFrame) -> int:
    """Shuffles in the plan as first chosen."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
