"""Row cleaning and de-duplication."""

from pyspark.sql import DataFrame, Window, functions as F


def drop_missing(df: DataFrame, required=(), not_blank=(), not_nan_text=()) -> DataFrame:
    """Drop rows with NULL in ``required``, blank text in ``not_blank``, NULL or 'NaN' in ``not_nan_text``."""
    keep = [F.col(c).isNotNull() for c in required]
    keep += [F.col(c) != "" for c in not_blank]
    keep += [F.col(c) != "NaN" for c in not_nan_text]
    for condition in keep:
        df = df.where(condition)
    return df


def cast_columns(df: DataFrame, types: dict) -> DataFrame:
    """Cast named columns; text that does not fit becomes NULL instead of an error."""
    return df.withColumns({name: F.col(name).try_cast(type_) for name, type_ in types.items()})


def first_per_key(df: DataFrame, keys, order_by) -> DataFrame:
    """One row per key: the first by ``order_by``.

    Spark drops the rows beyond the first before the shuffle as well
    (``WindowGroupLimit``), so a key with many copies sends one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def last_per_key(df: DataFrame, keys, order_by) -> DataFrame:
    """One row per key: the last by ``order_by`` (column names)."""
    return first_per_key(df, keys, [F.desc(c) if isinstance(c, str) else c.desc() for c in order_by])


def distinct_rows(df: DataFrame, *columns) -> DataFrame:
    """Distinct over all the named columns, as ``SELECT DISTINCT (a), b, c`` is."""
    return df.select(*columns).distinct()


def split_by_range(df: DataFrame, column, low_above, low_upto, high_above) -> tuple[DataFrame, DataFrame]:
    """The rows with ``low_above < column <= low_upto`` and those with ``column > high_above``."""
    c = F.col(column)
    return df.where((c > low_above) & (c <= low_upto)), df.where(c > high_above)


def range_extremes(df: DataFrame, column, low_above, low_upto, high_above) -> DataFrame:
    """Smallest value of the low range and largest of the high range, in one pass."""
    c = F.col(column)
    return df.agg(
        F.min(F.when((c > low_above) & (c <= low_upto), c)).alias("lowest"),
        F.max(F.when(c > high_above, c)).alias("highest"),
    )
