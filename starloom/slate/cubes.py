"""OLAP cube queries and the Star Schema Benchmark."""

from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.functions.money import hundredths, units_to_money
from starloom.operators import cubes
from starloom.operators.aggregate import top_k
from starloom.operators.writes import load_table
from starloom.plans import ssb
from starloom.session import read_table, work_folder
from starloom.slate import query
from starloom.slate.roles import AMOUNT, lines, money, orders, sales_fact

# Levels of the customer dimension, fine to coarse.
CUSTOMER_LEVELS = ["district", "city", "country"]


def _star(spark, d):
    """Sales with day, movie rating and customer place.

    Orders, fewer than lines, meet the customers before the lines do. Filters
    on the dimensions move into the dimension scans. A key that holds
    much of the sales is split by Spark's skew-join handling; sums over these
    keys would hardly shrink the sales before the last join.
    """
    movie = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("rating"))
    sold = orders(spark, d).select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("c_custkey"),
        F.dayofmonth("o_orderdate").alias("day"),
    )
    rated = lines(spark, d, "l_orderkey", "l_partkey").join(movie, "l_partkey")
    bought = sold.join(_customer_dim(spark, d), "c_custkey")
    return rated.join(bought, "l_orderkey").withColumnRenamed("amount", "sales_amount")


def _customer_dim(spark, d):
    place = read_table(spark, d, "nation").join(
        read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        read_table(spark, d, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.concat_ws("/", "n_name", "c_mktsegment").alias("district"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
        )
    )


def _top(cells, *tiebreak):
    return top_k(cells, "revenue", 20, *tiebreak).withColumn("revenue", units_to_money(F.col("revenue")))


_STAR = """
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey"""
_DAY = "cast(day(o_orderdate) as integer)"


def _cell_sql(level, alias, where=""):
    return f"""
select {_DAY} as day, p_type as rating, {level} as {alias}, {money(f'sum({AMOUNT})')} as revenue
{_STAR} {where}
group by 1, 2, 3 order by sum({AMOUNT}) desc, day, rating, {alias} limit 20"""


@query(_cell_sql("n_name", "city"))
def star_cube_cell(spark, d):
    dims = ["day", "rating", "city"]
    return _top(cubes.cube_cells(_star(spark, d), dims, "sales_amount"), *dims)


@query(_cell_sql("n_name", "city", "where p_type = 'PROMO'"))
def slice_rating(spark, d):
    dims = ["day", "rating", "city"]
    return _top(cubes.slice_cube(_star(spark, d), dims, "sales_amount", "rating", "PROMO"), *dims)


@query(
    _cell_sql(
        "n_name",
        "city",
        "where p_type in ('PROMO', 'SMALL') and n_name in ('NATION_1', 'NATION_7') and day(o_orderdate) in (1, 15, 30)",
    )
)
def dice_cells(spark, d):
    dims = ["day", "rating", "city"]
    keep = {"rating": ["PROMO", "SMALL"], "city": ["NATION_1", "NATION_7"], "day": [1, 15, 30]}
    return _top(cubes.dice_cube(_star(spark, d), dims, "sales_amount", keep), *dims)


@query(_cell_sql("r_name", "country"))
def rollup_region(spark, d):
    cells = cubes.roll_up(_star(spark, d), ["day", "rating", "city"], CUSTOMER_LEVELS, "sales_amount")
    return _top(cells, "day", "rating", "country")


@query(_cell_sql("n_name || '/' || c_mktsegment", "district"))
def drill_segment(spark, d):
    cells = cubes.drill_down(_star(spark, d), ["day", "rating", "city"], CUSTOMER_LEVELS, "sales_amount")
    return _top(cells, "day", "rating", "district")


def _month_country(spark, d):
    """Fact with month and store country, reduced to one row per order month and store first."""
    place = read_table(spark, d, "nation").join(
        read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    seller = (
        read_table(spark, d, "supplier")
        .join(place, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("store_key"), F.col("r_name").alias("country"))
    )
    month = (F.floor(F.col("date_key") / 100) % 100).cast("int").alias("month")
    fact = sales_fact(spark, d).groupBy(month, "store_key").agg(F.sum("sales_amount").alias("sales_amount"))
    return fact.join(seller, "store_key")


def _finish(totals):
    return totals.withColumn("revenue", units_to_money(F.col("revenue")))


_TOTALS = f"""
select cast(month(o_orderdate) as integer) as month, r_name as country,
       cast(grouping(month(o_orderdate)) * 2 + grouping(r_name) as integer) as grouping_id,
       {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by grouping sets ((), (month(o_orderdate)), (r_name), (month(o_orderdate), r_name))"""
_DIMS = ["month", "country"]
_SETS = [[], ["month"], ["country"], ["month", "country"]]


@query(_TOTALS)
def grouping_sets_sales(spark, d):
    return _finish(cubes.grouping_sets(_month_country(spark, d), _DIMS, _SETS, "sales_amount"))


@query(_TOTALS)
def cube_sales(spark, d):
    return _finish(cubes.cube_totals(_month_country(spark, d), _DIMS, "sales_amount"))


@query(_TOTALS)
def union_sales(spark, d):
    return _finish(cubes.union_totals(_month_country(spark, d), _DIMS, _SETS, "sales_amount"))


@query(f"""
select r_name as country, {money(f'sum({AMOUNT})')} as revenue
from lineitem join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1""")
def stored_cube_countries(spark, d):
    """The cube stored as a table; a coarser report then reads cells instead of sales."""
    path = work_folder(spark, "cube")
    totals = load_table(cubes.cube_totals(_month_country(spark, d), _DIMS, "sales_amount"), path).where("grouping_id = 2")
    return _finish(totals.select("country", "revenue"))


# Star Schema Benchmark


# Orders stand for the date table: a line's date key is its order key, and the
# order knows its day.


def _lineorder(lines):
    discount = hundredths("l_discount")
    return lines.select(
        F.col("l_orderkey").alias("lo_orderdate"),
        F.col("l_partkey").alias("lo_partkey"),
        F.col("l_suppkey").alias("lo_suppkey"),
        F.col("l_quantity").cast("int").alias("lo_quantity"),
        hundredths("l_extendedprice").alias("lo_extendedprice"),
        discount.alias("lo_discount"),
        (hundredths("l_extendedprice") * (100 - discount)).cast("decimal(18,0)").alias("lo_revenue"),
    )


def _dates(days):
    return days.select(
        F.col("o_orderkey").alias("d_datekey"),
        F.year("o_orderdate").alias("d_year"),
        F.date_format("o_orderdate", "MMMyyyy").alias("d_yearmonth"),
    )


def _place(spark, d):
    return read_table(spark, d, "nation").join(
        read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


_GROSS = "cast(l_extendedprice as decimal(12,2)) * cast(round(l_discount * 100) as decimal(4,0))"


@query(f"""
select cast(sum({_GROSS}) as double) as revenue
from lineitem join orders on l_orderkey = o_orderkey
where year(o_orderdate) = 1997 and round(l_discount * 100) between 1 and 3 and l_quantity < 24""")
def ssb_one_dim(spark, d):
    """The plain ranges around the rounded ones reach the scans."""
    lines = read_table(spark, d, "lineitem").where("l_discount >= 0.005 and l_discount <= 0.035 and l_quantity < 24")
    days = orders(spark, d).where("o_orderdate >= '1997-01-01' and o_orderdate < '1998-01-01'")
    total = ssb.one_dimension(_lineorder(lines), _dates(days), 1997, (1, 3), 24)
    return total.select(F.round(F.col("revenue") / 100, 2).cast("double").alias("revenue"))


@query(f"""
select cast(year(o_orderdate) as integer) as d_year, p_brand as p_brand1, {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
where p_type = 'PROMO' and r_name = 'AMERICA' group by 1, 2""")
def ssb_two_dim(spark, d):
    part = read_table(spark, d, "part").select(
        "p_partkey", F.col("p_brand").alias("p_brand1"), F.col("p_type").alias("p_category")
    )
    seller = (
        read_table(spark, d, "supplier")
        .join(_place(spark, d), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("r_name").alias("s_region"))
    )
    return _finish(ssb.two_dimensions(_lineorder(read_table(spark, d, "lineitem")), _dates(orders(spark, d)), part, seller, "PROMO", "AMERICA"))


@query(f"""
select c.n_name as c_city, s.n_name as s_city, cast(year(o_orderdate) as integer) as d_year,
       {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation c on c_nationkey = c.n_nationkey join supplier on l_suppkey = s_suppkey
join nation s on s_nationkey = s.n_nationkey
where c.n_name in ('NATION_1', 'NATION_5') and s.n_name in ('NATION_1', 'NATION_5')
and year(o_orderdate) = 1997 and month(o_orderdate) = 12 group by 1, 2, 3""")
def ssb_drill(spark, d):
    place = _place(spark, d)
    buyer = (
        read_table(spark, d, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("c_city"))
    )
    seller = (
        read_table(spark, d, "supplier")
        .join(place, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("s_city"))
    )
    cities = ["NATION_1", "NATION_5"]
    sold = orders(spark, d).where("o_orderdate >= '1997-12-01' and o_orderdate < '1998-01-01'").select(
        F.col("o_orderkey").alias("lo_orderdate"), F.col("o_custkey").alias("lo_custkey")
    )
    sold = sold.withColumns({"d_datekey": F.col("lo_orderdate"), "d_year": F.lit(1997), "d_yearmonth": F.lit("Dec1997")})
    # The few sellers cut the lines before the orders of the month are met, and orders are read once.
    lines = _lineorder(read_table(spark, d, "lineitem"))
    return _finish(ssb.drill_orders(lines, sold.drop("lo_orderdate"), buyer, seller, cities, "Dec1997"))


@query(f"""
select cast(strftime(o_orderdate, '%Y%m%d') as integer) as lo_orderdate, cast(sum({_GROSS}) as double) as revenue
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by 1""")
def ssb_same_dist(spark, d):
    part = read_table(spark, d, "part").select("p_partkey")
    per_order = ssb.same_distribution(_lineorder(read_table(spark, d, "lineitem")), part)
    day = orders(spark, d).select(F.col("o_orderkey").alias("lo_orderdate"), date_key("o_orderdate").alias("day"))
    per_day = per_order.join(day, "lo_orderdate").groupBy(F.col("day").alias("lo_orderdate"))
    totals = per_day.agg(F.sum("revenue").alias("revenue"))
    return totals.withColumn("revenue", F.round(F.col("revenue") / 100, 2).cast("double"))
