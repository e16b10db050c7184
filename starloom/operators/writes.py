"""Table writes."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.keys import add_dense_keys
from starloom.operators.snapshots import append_rows, newest, read_state, replace_rows
from starloom.schemas import empty_table


def write_partitioned(df: DataFrame, path, *columns, mode="overwrite", dynamic=False) -> None:
    """Parquet with one folder per partition value.

    The rows are rebalanced on the partition columns: small values end up in
    one file, and Spark splits a value that is too large for one task.
    """
    if columns:
        df = df.hint("rebalance", *columns)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.partitionBy(*columns).parquet(path)


def write_csv(df: DataFrame, path, sep=",", quote_all=False, compression=None, mode="overwrite") -> None:
    writer = df.write.mode(mode).option("header", True).option("sep", sep).option("quoteAll", quote_all)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def create_table(spark: SparkSession, root, name, replace=False) -> str:
    """An empty table of the data model; one that exists stays unless it is to be replaced."""
    path = f"{root}/{name}"
    if replace or newest(spark, path) is None:
        replace_rows(empty_table(spark, name), path)
    return path


def load_table(df: DataFrame, path, mode="overwrite") -> DataFrame:
    """Replace the rows of a table, or add to them; returns the table as read back.

    The rows are written aside and published in one step
    (``operators.snapshots``): until then, and after a failure, the old rows are
    what is read, also by ``df`` itself.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode is 'overwrite' or 'append'")
    (replace_rows if mode == "overwrite" else append_rows)(df, path)
    return read_loaded(df.sparkSession, path)


def read_loaded(spark: SparkSession, path) -> DataFrame:
    """The newest published rows of a table."""
    return read_state(spark, path)


def normalise(df: DataFrame, key, items, item_name, parent_cols) -> tuple[DataFrame, DataFrame]:
    """Split rows with a list column into a parent table and one row per list item.

    Items are numbered by their place in the list.
    """
    parents = df.select(key, *parent_cols).distinct()
    children = df.select(key, F.posexplode(items).alias("position", item_name)).distinct()
    return parents, children


def normalise_values(df: DataFrame, column, key) -> tuple[DataFrame, DataFrame]:
    """Move the values of a column into a table of their own.

    Returns that table (``key``, ``column``) with keys 1, 2, ... and ``df`` with
    the key in place of the value. NULL stays without a key.
    """
    values = add_dense_keys(df.select(column).where(F.col(column).isNotNull()).distinct(), column, key)
    return values.select(key, column), df.join(values, column, "left").drop(column)


def denormalise(parents: DataFrame, children: DataFrame, key) -> DataFrame:
    """Parent columns repeated on each child row."""
    return children.join(parents, key)
