"""Stored query tables: files laid out for the lookups of one query.

Rows are range-partitioned and sorted by partition key and clustering columns,
so a file covers a narrow range of keys; its row groups are small and carry
their key ranges and a Bloom filter on every partition column. A lookup is an
equality on these columns that is pushed into the scan: row groups whose range
or filter excludes the value are not read.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.operators.snapshots import read_state, replace_rows
from starloom.operators.upsert import build_query_table

#: Bytes of a row group: what a lookup reads at least.
ROW_GROUP = 16 << 20


def skipping_options(columns, row_group=ROW_GROUP) -> dict:
    """Parquet options for small row groups with a Bloom filter on each of the columns, sized by its values."""
    filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {"parquet.block.size": str(row_group), "parquet.bloom.filter.adaptive.enabled": "true", **filters}


def store_query_table(
    df: DataFrame, root, partition_cols, clustering_cols, cols, order_by=None, row_group=ROW_GROUP
) -> None:
    """Write the table of one query; a later write replaces it in one step.

    One row per key stays, the last by ``order_by`` where rows share a key.
    """
    table = build_query_table(df, partition_cols, clustering_cols, cols, order_by)
    replace_rows(table, root, skipping_options(partition_cols, row_group))


def lookup(table: DataFrame, **key) -> DataFrame:
    """Rows of a query table for the given key values. Values take the column's type, so the equality reaches the scan."""
    types = {f.name: f.dataType for f in table.schema.fields}
    for column, value in key.items():
        table = table.where(F.col(column) == F.lit(value).cast(types[column]))
    return table


def lookup_stored(spark: SparkSession, root, **key) -> DataFrame:
    return lookup(read_state(spark, root), **key)


def rows_scanned(df: DataFrame) -> int:
    """Rows that the file scans of a frame return when it is run: what skipping leaves."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
