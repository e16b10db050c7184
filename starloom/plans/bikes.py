"""Bike-trip warehouse: station traffic, trip facts, rider and ride counts."""

from pyspark.sql import DataFrame, functions as F

from starloom.operators import quality
from starloom.operators.aggregate import facts_summary, group_count
from starloom.operators.clean import range_extremes, split_by_range
from starloom.operators.joins import join_two_counts
from starloom.operators.writes import load_table
from starloom.sources.files import stage_csv

# Birth-year limits of older (upto) and younger (above) riders.
OLDER_ABOVE, OLDER_UPTO, YOUNGER_ABOVE = 0, 1945, 2000


def station_traffic(trips: DataFrame) -> DataFrame:
    """Departures and arrivals of the stations that have both, one row per station name."""
    return join_two_counts(
        trips, "from_station_id", "from_station_name", "to_station_id", "num_departures", "num_arrivals"
    ).select(
        F.col("from_station_id").alias("station_id"),
        F.col("from_station_name").alias("station_name"),
        "num_departures",
        "num_arrivals",
    )


def trip_facts(trips: DataFrame) -> DataFrame:
    """Longest, shortest and average trip per bike."""
    return facts_summary(trips, "tripduration", "bikeid")


def older_younger(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_by_range(trips, "birthyear", OLDER_ABOVE, OLDER_UPTO, YOUNGER_ABOVE)


def rider_extremes(trips: DataFrame) -> DataFrame:
    """Birth year of the oldest of the older and the youngest of the younger riders."""
    return range_extremes(trips, "birthyear", OLDER_ABOVE, OLDER_UPTO, YOUNGER_ABOVE).select(
        F.col("lowest").alias("oldest_birthyear"), F.col("highest").alias("youngest_birthyear")
    )


def lifetime_rides(trips: DataFrame) -> DataFrame:
    return group_count(trips, "bikeid", column="bikeid")


def city_station_counts(stations: DataFrame) -> DataFrame:
    return group_count(stations, "city", column="city")


def stage_and_check(spark, source, schema, target, sep=",", mode="overwrite") -> DataFrame:
    """Load a delimited file into a table and raise unless it has rows."""
    table = load_table(stage_csv(spark, source, schema, sep=sep), target, mode)
    quality.enforce(quality.check_rows(table, target))
    return table
