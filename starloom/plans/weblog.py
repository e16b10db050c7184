"""Web access log, schema on read."""

from pyspark.sql import DataFrame, functions as F

from starloom.functions import dates, text
from starloom.operators.aggregate import group_count, top_k


def parse_log(lines: DataFrame, line="value") -> DataFrame:
    """Lines with a map column ``parsed``; NULL where a line does not have the log's shape.

    The map comes out of an ``explode``, so that a line is parsed once and not
    again for every column and filter taken from the map.
    """
    return lines.select("*", F.explode(F.array(text.access_log_map(F.col(line)))).alias("parsed"))


def log_columns(parsed: DataFrame) -> DataFrame:
    """One text column per field, plus size, status and time with their types. Unparsed lines are left out."""
    fields = parsed.where("parsed is not null").select(*text.map_columns("parsed", text.ACCESS_LOG_FIELDS))
    return fields.withColumns(
        {
            "content_size_bytes": F.col("content_size").try_cast("long"),
            "status": F.col("response_code").try_cast("int"),
            "time": dates.log_time("date_time"),
        }
    )


def reject_count(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.count("*").alias("lines"), F.count_if(F.col("parsed").isNull()).alias("rejected"))


def popular(log: DataFrame, field, k=10) -> DataFrame:
    """Most frequent hosts or endpoints."""
    return top_k(group_count(log, field), "count", k, field)


def largest(log: DataFrame, k=10, as_text=False) -> DataFrame:
    """Largest files by number; ``as_text`` shows the order the raw text column would give."""
    order = "content_size" if as_text else "content_size_bytes"
    return log.orderBy(F.desc_nulls_last(order), "endpoint", "host", "date_time").limit(k).select("endpoint", "content_size")
