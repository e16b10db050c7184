"""Data-quality checks. Every check gives rows ``(check, failed, passed)``."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class DataQualityError(Exception):
    """A table failed a check."""


def _result(df: DataFrame, check: str) -> DataFrame:
    """From one row with a ``failed`` count."""
    failed = F.coalesce(F.col("failed"), F.lit(0)).cast("long")
    return df.select(F.lit(check).alias("check"), failed.alias("failed"), (failed == 0).alias("passed"))


def all_checks(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def check_rows(df: DataFrame, name: str) -> DataFrame:
    """The table has a row. Looked up at once, reading one part of the table after another until one is found."""
    empty = df.select(F.lit(1)).isEmpty()
    return _result(df.sparkSession.range(1).select(F.lit(int(empty)).alias("failed")), f"{name}: has rows")


def check_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Every table is there and has a row."""
    results = []
    for name, path in paths.items():
        try:
            results.append(check_rows(spark.read.parquet(path), name))
        except AnalysisException:
            missing = spark.range(1).select(F.lit(1).alias("failed"))
            results.append(_result(missing, f"{name}: has rows"))
    return all_checks(*results)


def check_columns(df: DataFrame, name: str, conditions: dict[str, Column]) -> DataFrame:
    """Count the rows that break each condition, all in one pass; NULL breaks a condition."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"_{n}") for n, c in enumerate(conditions.values())])
    rows = [
        F.struct(F.lit(f"{name}: {label}").alias("check"), F.col(f"_{n}").alias("failed"))
        for n, label in enumerate(conditions)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("row")).select(
        "row.check", "row.failed", (F.col("row.failed") == 0).alias("passed")
    )


def not_null(*columns) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNotNull() for c in columns}


def in_values(column, values) -> dict[str, Column]:
    """NULL passes, as in a checked domain."""
    return {f"{column} in domain": F.col(column).isNull() | F.col(column).isin(list(values))}


def in_range(column, low, high) -> dict[str, Column]:
    return {f"{column} in range": F.col(column).isNull() | F.col(column).between(low, high)}


def check_unique(df: DataFrame, name: str, keys) -> DataFrame:
    """Number of key values that occur more than once; rows with a NULL in the key do not count."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    repeated = df.where(complete).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return _result(repeated.agg(F.count("*").alias("failed")), f"{name}: {', '.join(keys)} unique")


def check_primary_key(df: DataFrame, name: str, keys) -> DataFrame:
    return all_checks(check_unique(df, name, keys), check_columns(df, name, not_null(*keys)))


def check_foreign_key(child: DataFrame, key, parent: DataFrame, parent_key, name: str) -> DataFrame:
    """Child rows whose key is not NULL and not in the parent; keys are counted before the join."""
    keys = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n"))
    orphans = keys.join(parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
    return _result(orphans.agg(F.sum("n").alias("failed")), f"{name}: {key} in parent")


def check_expected(cases) -> DataFrame:
    """``(name, one-value DataFrame, expected value)`` cases: failed is 1 where the value differs."""
    results = []
    for name, df, expected in cases:
        same = F.col(df.columns[0]).eqNullSafe(F.lit(expected))
        results.append(_result(df.select(F.when(same, 0).otherwise(1).alias("failed")), name))
    return all_checks(*results)


def count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Records of each table and whether there are any."""
    rows = [
        df.agg(F.count("*").alias("records")).select(
            F.lit(name).alias("check"), "records", (F.col("records") > 0).alias("passed")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def enforce(report: DataFrame) -> None:
    """Raise with the failed checks of a report, if any; a report has one row per check."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise DataQualityError("; ".join(f"{row[0]} ({row[1]})" for row in failed))
