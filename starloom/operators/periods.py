"""Running totals per user: phases before and after an event, periods between events.

Totals are distributed prefix sums (``operators.prefix``): a user's history may
fill any number of partitions.
"""

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.prefix import running_sums


def flag_phase(df: DataFrame, user: str, ts: str, flag: Column, frame="range", tiebreak=(), name="phase") -> DataFrame:
    """Number of flagged rows of the user at or after each row's time.

    ``frame="range"`` counts all rows that share the time; ``frame="rows"``
    counts in the order newest first, then ``tiebreak``.
    """
    order = [F.desc(ts), *(tiebreak if frame == "rows" else ())]
    return running_sums(df, [user], order, {name: flag.cast("long")}, frame)


def period_counts(
    df: DataFrame, user: str, ts: str, item: Column, marker: Column, closed_only=False, frame="range", **options
) -> DataFrame:
    """Items of a user in each period between markers.

    Period ``p`` holds what lies before the ``p``-th newest marker and after
    the next older one; period 0 and the oldest one are open-ended and left out
    with ``closed_only``.
    """
    rows = df.where(item | marker).withColumn("_item", item).withColumn("_marker", marker.cast("long"))
    phased = flag_phase(rows, user, ts, F.col("_marker"), frame, name="period", **options)
    counts = phased.groupBy(user, "period").agg(F.count_if("_item").alias("items"))
    if closed_only:
        markers = rows.groupBy(F.col(user).alias("_user")).agg(F.sum("_marker").alias("_last"))
        counts = counts.join(markers, F.col(user).eqNullSafe(F.col("_user"))).where("period > 0 and period < _last")
    return counts.where("items > 0").select(user, "period", "items")


def period_average(df: DataFrame, user: str, ts: str, item: Column, marker: Column, name="average", **options):
    """Average number of items in the periods that have any."""
    return period_counts(df, user, ts, item, marker, **options).agg(F.avg("items").alias(name))
