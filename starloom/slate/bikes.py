"""Bike-trip queries: lines as trips from a supplier's station, suppliers as stations."""

from pyspark.sql import functions as F

from starloom.operators.writes import write_csv
from starloom.plans import bikes
from starloom.session import read_table, work_folder
from starloom.slate import query

_TRAFFIC = """
with t as (select l_suppkey as station_id,
                  'Station ' || l_suppkey || case when l_linenumber = 7 then ' (new)' else '' end as station_name,
                  l_orderkey % 60 as to_id from lineitem),
a as (select station_id, count(*) as num_departures from t group by 1),
b as (select to_id, count(*) as num_arrivals from t group by 1)
select distinct t.station_id, station_name, num_departures, num_arrivals
from t join a on t.station_id = a.station_id join b on t.station_id = b.to_id"""


def _trips(spark, d):
    return read_table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("bikeid"),
        F.col("l_quantity").cast("decimal(16,2)").alias("tripduration"),
        F.col("l_suppkey").alias("from_station_id"),
        F.concat(
            F.lit("Station "),
            F.col("l_suppkey").cast("string"),
            F.when(F.col("l_linenumber") == 7, " (new)").otherwise(""),
        ).alias("from_station_name"),
        (F.col("l_orderkey") % 60).alias("to_station_id"),
        F.when(F.col("l_linenumber") > 1, (F.lit(1910) + F.col("l_quantity") * 2).cast("int")).alias("birthyear"),
    )


@query(_TRAFFIC)
def station_traffic(spark, d):
    return bikes.station_traffic(_trips(spark, d))


@query(_TRAFFIC)
def station_traffic_from_files(spark, d):
    """Trip files staged, checked for rows, then counted."""
    folder = work_folder(spark, "trips")
    kept = ["from_station_id", "from_station_name", "to_station_id"]
    write_csv(_trips(spark, d).select(*kept), f"{folder}/csv")
    schema = "from_station_id long, from_station_name string, to_station_id long"
    return bikes.station_traffic(bikes.stage_and_check(spark, f"{folder}/csv", schema, f"{folder}/trips"))


@query("""
select l_partkey as bikeid, cast(max(l_quantity) as double) as max_tripduration,
       cast(min(l_quantity) as double) as min_tripduration, round(avg(l_quantity), 6) as average_tripduration
from lineitem group by 1""")
def trip_facts(spark, d):
    facts = bikes.trip_facts(_trips(spark, d).withColumn("tripduration", F.col("tripduration").cast("double")))
    return facts.withColumn("average_tripduration", F.round("average_tripduration", 6))


_BORN = "(select cast(1910 + l_quantity * 2 as integer) as y from lineitem where l_linenumber > 1)"


@query(f"""
select min(y) filter (where y > 0 and y <= 1945) as oldest_birthyear, max(y) filter (where y > 2000) as youngest_birthyear
from {_BORN}""")
def rider_extremes(spark, d):
    return bikes.rider_extremes(_trips(spark, d))


@query(f"""
select 'older' as riders, count(*) as trips from {_BORN} where y > 0 and y <= 1945
union all select 'younger', count(*) from {_BORN} where y > 2000""")
def older_younger_trips(spark, d):
    """Rows of the two sub-tables."""
    older, younger = bikes.older_younger(_trips(spark, d))
    count = F.count("*").alias("trips")
    return older.agg(count).select(F.lit("older").alias("riders"), "trips").unionByName(
        younger.agg(count).select(F.lit("younger").alias("riders"), "trips")
    )


@query("select l_partkey as bikeid, count(l_partkey) as count from lineitem group by 1")
def lifetime_rides(spark, d):
    return bikes.lifetime_rides(_trips(spark, d))


@query("select 'NATION_' || s_nationkey as city, count(*) as count from supplier group by 1")
def city_station_counts(spark, d):
    stations = read_table(spark, d, "supplier").select(
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("city")
    )
    return bikes.city_station_counts(stations)
