"""Scans: JSON, CSV, text and Parquet files to DataFrames.

Every scan takes an explicit schema where it can, so no pass over the data is
spent on inference.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def scan_json(spark: SparkSession, path, schema=None, recursive=False, pattern=None) -> DataFrame:
    """JSON lines. Keys match the schema by exact name; missing ones are NULL."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(path)


def scan_json_any_case(spark: SparkSession, path, schema) -> DataFrame:
    """JSON lines of plain values, keys matched to a ``StructType`` without regard to case.

    Of keys that differ in case only the first counts; text that does not fit its type is NULL.
    """
    pairs = F.map_entries(F.from_json("value", "map<string,string>")).alias("pairs")

    def column(field):
        found = F.filter("pairs", lambda pair: F.lower(pair["key"]) == field.name.lower())
        return F.get(found, 0)["value"].try_cast(field.dataType).alias(field.name)

    return spark.read.text(path).select(pairs).select(*[column(field) for field in schema.fields])


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows read from each source file."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("records"))


def stage_json(spark: SparkSession, path, mapping, time_columns=(), **scan_options) -> DataFrame:
    """JSON loaded through an ordered path-to-column mapping.

    ``mapping`` is a list of ``(json path, column name, type)``; a path is a
    dotted field path. Columns in ``time_columns`` hold epoch milliseconds in
    the file and become timestamps.
    """
    fields = _nested_schema([(path_, "long" if name in time_columns else type_) for path_, name, type_ in mapping])
    source = scan_json(spark, path, fields, **scan_options)
    return source.select(
        *[
            (F.timestamp_millis(F.col(path_)) if name in time_columns else F.col(path_)).alias(name)
            for path_, name, type_ in mapping
        ]
    )


def _nested_schema(paths) -> str:
    """DDL of the struct that holds the dotted paths."""
    tree: dict = {}
    for path, type_ in paths:
        *parents, leaf = path.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = type_

    def ddl(node, sep):
        return ", ".join(
            f"`{name}`{sep}" + (f"struct<{ddl(inner, ': ')}>" if isinstance(inner, dict) else inner)
            for name, inner in node.items()
        )

    return ddl(tree, " ")


def stage_csv(
    spark: SparkSession, path, schema=None, sep=",", header=True, skip_lines=0, partitions=None, **options
) -> DataFrame:
    """Delimited text. Without a schema every column is text.

    ``skip_lines`` drops that many leading lines of every file, the header
    included. ``partitions`` spreads the rows of files that cannot be split,
    such as ``.gz``, before further work.
    """
    if skip_lines > 1:
        return _stage_skipping(spark, path, schema, sep, skip_lines, partitions, options)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path, sep=sep, header=header or skip_lines == 1, enforceSchema=True)
    return df.repartition(partitions) if partitions else df


def _stage_skipping(spark, path, schema, sep, skip_lines, partitions, options):
    """Lines to skip are found by counting: per file and block the first line id and the number of lines.

    Line ids rise by one within a block, so what is left of a block is a range
    of ids. Only blocks that lose lines are in the small table that the lines
    meet, which usually is the first block of each file.
    """
    if schema is None:
        raise ValueError("skip_lines above 1 needs a schema")
    lines = scan_lines(spark, path).select("file", "line_no.block", "line_no.line", "value")
    blocks = lines.groupBy("file", "block").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("lines"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("lines").over(earlier), F.lit(0))
    skipped = F.least(F.col("lines"), F.lit(skip_lines) - before)
    starts = blocks.select("file", "block", (F.col("first") + skipped).alias("start"), skipped.alias("skipped"))
    kept = lines.join(starts.where("skipped > 0"), ["file", "block"], "left").where("start is null or line >= start")
    parsed = (
        kept.where("value <> ''")
        .select(F.from_csv("value", _ddl(schema), {"sep": sep, **options}).alias("row"))
        .select("row.*")
    )
    return parsed.repartition(partitions) if partitions else parsed


def _ddl(schema) -> str:
    if isinstance(schema, str):
        return schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def scan_event_csv(spark: SparkSession, path, keep, required) -> DataFrame:
    """A folder of CSV files: the columns to keep, without rows where ``required`` is blank."""
    return stage_csv(spark, path).where(F.col(required).isNotNull() & (F.col(required) != "")).select(*keep)


def scan_text(spark: SparkSession, path) -> DataFrame:
    """One row per line, column ``value``; compressed files are read as they are."""
    return spark.read.text(path)


def scan_lines(spark: SparkSession, path) -> DataFrame:
    """Text lines with their file and ``line_no``, a struct that orders the lines of a file."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ).alias("line_no"),
        "value",
    )


def scan_parquet(spark: SparkSession, path, base_path=None) -> DataFrame:
    """Parquet by folder. For a glob over partition folders give ``base_path`` to keep their columns."""
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(path)


def month_path(template: str, run_date) -> str:
    """A path such as ``trips/{year}/{month}/file.csv`` for the month of a run date."""
    return template.format(year=run_date.year, month=run_date.month)


def month_slice(df: DataFrame, run_date, year="year", month="month") -> DataFrame:
    """The month of a run date from a table partitioned by year and month."""
    return df.where((F.col(year) == run_date.year) & (F.col(month) == run_date.month))


def literal_rows(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def describe_table(df: DataFrame) -> DataFrame:
    """Column names and types, in order."""
    rows = [(n, f.name, f.dataType.simpleString(), f.nullable) for n, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
