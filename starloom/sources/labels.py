"""Lookup files: ``'code' = 'label'`` lines and blocks of value labels."""

from pyspark.sql import DataFrame, Window, functions as F

# Line shapes of the two lookup formats.
LABEL_LINE = r"'(.*)'.*'(.*)'"
BLOCK_START = r"^\s*value\s+\$?(\w+)"
BLOCK_LINE = r"^\s*'?([^'=]*?)'?\s*=\s*'([^']*)'"


def parse_labels(lines: DataFrame, text="value", keep=()) -> DataFrame:
    """Codes and labels of a lookup file; lines of another shape are skipped."""
    return lines.where(F.rlike(text, F.lit(LABEL_LINE))).select(
        *keep,
        F.regexp_extract(text, LABEL_LINE, 1).alias("code"),
        F.regexp_extract(text, LABEL_LINE, 2).alias("label"),
    )


def parse_label_blocks(lines: DataFrame, file="file", line_no="line_no", text="value") -> DataFrame:
    """Code/label rows of a file of named blocks (``value name`` followed by ``code = 'label'``).

    The block of a line is the last block start above it in its file. Lookup
    files are documentation-sized, so one file is one window group.
    """
    marked = lines.select(
        file,
        line_no,
        F.when(F.rlike(text, F.lit(BLOCK_START)), F.regexp_extract(text, BLOCK_START, 1)).alias("_start"),
        F.when(F.rlike(text, F.lit(BLOCK_LINE)), F.trim(F.regexp_extract(text, BLOCK_LINE, 1))).alias("code"),
        F.when(F.rlike(text, F.lit(BLOCK_LINE)), F.trim(F.regexp_extract(text, BLOCK_LINE, 2))).alias("label"),
    ).where("_start is not null or code is not null")
    above = Window.partitionBy(file).orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.withColumn("block", F.last("_start", ignorenulls=True).over(above))
        .where("code is not null and block is not null")
        .select(file, "block", "code", "label")
    )
