"""Immigration queries: orders as arrivals, nations as ports, customers as temperature rows."""

from pyspark.sql import functions as F

from starloom.functions.dates import day_number_date
from starloom.functions.text import capitalised
from starloom.plans import immigration
from starloom.operators.quality import count_report
from starloom.session import read_table, work_folder
from starloom.slate import query
from starloom.sources.labels import parse_labels


def ports(spark, d):
    """Port labels read from lookup lines made of the nations (a table of fixed size)."""
    place = read_table(spark, d, "nation").join(
        read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    lines = place.select(
        F.col("n_nationkey").alias("line_no"),
        F.format_string("'P%02d'\t=\t'%s, %s   '", "n_nationkey", "n_name", "r_name").alias("value"),
    )
    return parse_labels(lines, keep=["line_no"])


def _arrivals(spark, d):
    number = F.date_diff("o_orderdate", F.lit("1960-01-01").cast("date"))
    return read_table(spark, d, "orders").select(
        F.year("o_orderdate").alias("i94yr"),
        F.month("o_orderdate").alias("i94mon"),
        (F.col("o_custkey") % 300).cast("int").alias("i94cit"),
        F.format_string("P%02d", F.dayofmonth("o_orderdate")).alias("i94port"),
        number.alias("arrdate"),
        F.lit(1).alias("i94mode"),
        F.when(F.col("o_orderstatus") != "O", number + 9).alias("depdate"),
        (F.col("o_orderkey") % 3).cast("int").alias("i94visa"),
    )


def _temperature(spark, d):
    """City is a nation, a region or (as no port's city) a market segment."""
    place = read_table(spark, d, "nation").join(
        read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    kind = F.col("c_custkey") % 3
    city = F.when(kind == 0, F.lower("n_name")).when(kind == 1, capitalised("r_name")).otherwise(F.col("c_mktsegment"))
    return (
        read_table(spark, d, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.when(F.col("c_acctbal") < 0, "NaN").otherwise(F.col("c_custkey").cast("string")).alias("AverageTemperature"),
            city.alias("City"),
            F.col("c_mktsegment").alias("Country"),
            F.col("n_nationkey").cast("string").alias("Latitude"),
            F.col("n_regionkey").cast("string").alias("Longitude"),
        )
    )


_TEMPERATURE = """
with place as (select * from nation join region on n_regionkey = r_regionkey),
t as (
  select c_custkey, cast(c_custkey as varchar) as temperature, c_mktsegment as country, n_nationkey as lat, n_regionkey as lon,
         case c_custkey % 3 when 0 then lower(n_name) when 1 then r_name else c_mktsegment end as city_raw
  from customer join place on c_nationkey = n_nationkey where c_acctbal >= 0),
u as (select *, case when c_custkey % 3 = 1 then upper(city_raw[1]) || lower(city_raw[2:]) else city_raw end as city from t),
one as (select * from (select *, row_number() over (partition by city, country order by c_custkey) as n from u) where n = 1),
port as (select n_nationkey, printf('P%02d', n_nationkey) as code, n_name || ', ' || r_name as label from place),
located as (
  select city, country, any_value(temperature) as temperature, cast(any_value(lat) as varchar) as latitude,
         cast(any_value(lon) as varchar) as longitude, arg_min(code, port.n_nationkey) as i94port
  from one join port on contains(lower(label), lower(city)) group by city, country)
"""


@query(_TEMPERATURE + """
select temperature as "AverageTemperature", city as "City", country as "Country", latitude as "Latitude",
       longitude as "Longitude", i94port from located""")
def port_temperature(spark, d):
    """Measured cities with the first port whose label contains the city."""
    return immigration.port_temperature(_temperature(spark, d), ports(spark, d), ["c_custkey"])


@query("""
select cast(year(o_orderdate) as integer) as i94yr, cast(month(o_orderdate) as integer) as i94mon, count(*) as arrivals,
       max(cast(o_orderdate as date)) as last_arrival
from orders where day(o_orderdate) < 25 group by 1, 2""")
def valid_immigration(spark, d):
    """Arrivals at known ports per month, day numbers turned into dates."""
    kept = immigration.valid_immigration(_arrivals(spark, d), ports(spark, d))
    return kept.groupBy("i94yr", "i94mon").agg(
        F.count("*").alias("arrivals"), F.max(day_number_date("arrdate")).alias("last_arrival")
    )


@query(_TEMPERATURE + """
select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
       cast(o_custkey % 300 as integer) as city, i94port,
       cast(datediff('day', date '1960-01-01', cast(o_orderdate as date)) as integer) as arrival_date,
       cast(case when o_orderstatus <> 'O' then datediff('day', date '1960-01-01', cast(o_orderdate as date)) + 9 end as integer)
         as departure_date,
       cast(o_orderkey % 3 as integer) as reason, temperature, latitude, longitude
from orders join located on printf('P%02d', day(o_orderdate)) = i94port""")
def immigration_fact(spark, d):
    found = ports(spark, d)
    records = immigration.valid_immigration(_arrivals(spark, d), found)
    cities = immigration.port_temperature(_temperature(spark, d), found, ["c_custkey"])
    return immigration.immigration_fact(records, cities)


@query(_TEMPERATURE + """
select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
       cast(o_custkey % 300 as integer) as city, i94port,
       cast(datediff('day', date '1960-01-01', cast(o_orderdate as date)) as integer) as arrival_date,
       cast(o_orderkey % 3 as integer) as reason, temperature
from orders join located on printf('P%02d', day(o_orderdate)) = i94port where i94port in ('P03', 'P17')""")
def immigration_port_rows(spark, d):
    """The stored fact as read back, for two ports: only their folders are read."""
    folder = work_folder(spark, "immigration")
    immigration.write_tables(_arrivals(spark, d), _temperature(spark, d), ports(spark, d), folder, ["c_custkey"])
    fact = spark.read.parquet(f"{folder}/fact").where(F.col("i94port").isin("P03", "P17"))
    return fact.select("year", "month", "city", "i94port", "arrival_date", "reason", "temperature")


@query(_TEMPERATURE + """
select 'immigration' as "check", count(*) as records, count(*) > 0 as passed from orders where day(o_orderdate) < 25
union all select 'temperature', count(*), count(*) > 0 from located
union all select 'fact', count(*), count(*) > 0 from orders join located on printf('P%02d', day(o_orderdate)) = i94port""")
def immigration_tables(spark, d):
    """All three tables written by port, counted as read back."""
    folder = work_folder(spark, "immigration")
    immigration.write_tables(_arrivals(spark, d), _temperature(spark, d), ports(spark, d), folder, ["c_custkey"])
    return count_report({n: spark.read.parquet(f"{folder}/{n}") for n in ("immigration", "temperature", "fact")})
