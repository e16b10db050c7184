"""Scheduled loads of dated rows."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.operators.writes import write_partitioned


def load_partition(df: DataFrame, path, ts, run_date) -> None:
    """Load the month of a run date; a rerun replaces that month and no other.

    A month without rows leaves the table as it is.
    """
    backfill(df, path, ts, run_date, run_date)


def backfill(df: DataFrame, path, ts, start, end) -> None:
    """Load every month from that of ``start`` to that of ``end`` in one read and one write."""
    low = F.trunc(F.lit(start).cast("date"), "month")
    high = F.add_months(F.trunc(F.lit(end).cast("date"), "month"), 1)
    rows = df.where((F.col(ts) >= low) & (F.col(ts) < high))
    dated = rows.withColumns({"year": F.year(ts), "month": F.month(ts)})
    write_partitioned(dated, path, "year", "month", dynamic=True)


def run_months(spark: SparkSession, start, end) -> DataFrame:
    """The first day of every month between two dates."""
    days = F.sequence(
        F.trunc(F.lit(start).cast("date"), "month"),
        F.trunc(F.lit(end).cast("date"), "month"),
        F.expr("interval 1 month"),
    )
    return spark.range(1).select(F.explode(days).alias("month_start"))
