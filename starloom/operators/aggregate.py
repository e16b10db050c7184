"""Aggregates."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def table_counts(tables: dict) -> DataFrame:
    """Row count of every table."""
    counts = [df.agg(F.count("*").alias("records")).select(F.lit(n).alias("table"), "records") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def covered_period(df: DataFrame, ts) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def group_count(df: DataFrame, *keys, name="count", column=None) -> DataFrame:
    """Rows per group, or the non-NULL values of ``column`` per group."""
    return df.groupBy(*keys).agg(F.count(column or "*").alias(name))


def top_k(df: DataFrame, measure, k, *tiebreak, nulls_first=False) -> DataFrame:
    """The ``k`` rows with the largest measure; ties go to the smaller tiebreak.

    Spark puts NULL last in descending order, PostgreSQL first: ``nulls_first`` does as the latter.
    """
    order = F.desc_nulls_first(measure) if nulls_first else F.desc(measure)
    return df.orderBy(order, *tiebreak).limit(k)


def top_with_ties(df: DataFrame, measure) -> DataFrame:
    """All rows that share the largest value of the measure."""
    best = F.broadcast(df.agg(F.max(measure).alias("_max")))  # one row
    return df.join(best, F.col(measure) == F.col("_max")).drop("_max")


def average_group_count(df: DataFrame, keys, name="average") -> DataFrame:
    """Average number of rows per group."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.avg("_n").alias(name))


def facts_summary(df: DataFrame, fact, key) -> DataFrame:
    """Largest, smallest and average value of a column per key."""
    return df.groupBy(key).agg(
        F.max(fact).alias(f"max_{fact}"), F.min(fact).alias(f"min_{fact}"), F.avg(fact).alias(f"average_{fact}")
    )


def concat_by(df: DataFrame, keys, value: Column, name, sep=", ", distinct=False) -> DataFrame:
    """Values of each group joined to one text in sorted order, NULLs skipped.

    The text holds the whole list, so its length is the bound of this
    operator. With ``distinct`` repeats are dropped first, spread over all
    tasks, so that a large group shrinks before it is put together.
    """
    rows = df.select(*keys, value.alias("_value"))
    if distinct:
        rows = rows.distinct()
    text = sep.replace("\\", "\\\\").replace("'", "\\'")
    joined = F.expr(f"listagg(_value, '{text}') within group (order by _value)")
    return rows.groupBy(*keys).agg(joined.alias(name))


def word_count(df: DataFrame, text, pattern=r"\s+", name="word") -> DataFrame:
    """Occurrences of every word of a text column."""
    return df.select(F.explode(F.split(text, pattern)).alias(name)).groupBy(name).agg(F.count("*").alias("count"))


def summary_statistics(df: DataFrame, *columns) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of number columns, one row per column, in one pass."""
    measures = {"count": F.count, "mean": F.mean, "stddev": F.stddev, "min": F.min, "max": F.max}
    one_row = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), *[f(F.col(c).cast("double")).alias(m) for m, f in measures.items()]).alias(c)
            for c in columns
        ]
    )
    return one_row.select(F.explode(F.array(*columns)).alias("row")).select("row.*")


def having_totals(df: DataFrame, key, amount, min_rows, min_amount) -> DataFrame:
    """Keys with more than ``min_rows`` rows and more than ``min_amount`` in total."""
    return (
        df.groupBy(key)
        .agg(F.sum(amount).alias("total"), F.count("*").alias("purchases"))
        .where((F.col("total") > min_amount) & (F.col("purchases") > min_rows))
    )
