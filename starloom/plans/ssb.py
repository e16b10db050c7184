"""Star Schema Benchmark queries over ``lineorder, part, supplier, customer, dwdate``.

The line table is first cut by its selective dimensions and summed per
remaining key, then joined to the others.
"""

from pyspark.sql import DataFrame, functions as F

from starloom.functions import dates

def date_table(days: DataFrame, ts: str) -> DataFrame:
    """``dwdate`` for the days between the first and last of a time column."""
    span = days.agg(F.to_date(F.min(ts)).alias("first"), F.to_date(F.max(ts)).alias("last"))
    day = span.select(F.explode(F.sequence("first", "last")).alias("d"))
    return day.select(
        dates.date_key("d").alias("d_datekey"),
        F.year("d").alias("d_year"),
        F.date_format("d", "MMMyyyy").alias("d_yearmonth"),
        F.weekofyear("d").alias("d_weeknuminyear"),
    )


def one_dimension(lineorder, dwdate, year, discounts, quantity_below) -> DataFrame:
    """Revenue of discounted lines of one year."""
    lines = lineorder.where(
        F.col("lo_discount").between(*discounts) & (F.col("lo_quantity") < quantity_below)
    )
    per_day = lines.groupBy("lo_orderdate").agg(F.sum(_discounted()).alias("revenue"))
    year_days = dwdate.where(F.col("d_year") == year)
    return per_day.join(year_days, F.col("lo_orderdate") == F.col("d_datekey")).agg(F.sum("revenue").alias("revenue"))


def two_dimensions(lineorder, dwdate, part, supplier, category, region) -> DataFrame:
    """Revenue by year and brand for a part category and supplier region."""
    lines = (
        lineorder.join(part.where(F.col("p_category") == category), F.col("lo_partkey") == F.col("p_partkey"))
        .join(supplier.where(F.col("s_region") == region), F.col("lo_suppkey") == F.col("s_suppkey"), "left_semi")
        .groupBy("lo_orderdate", "p_brand1")
        .agg(F.sum("lo_revenue").alias("revenue"))
    )
    return (
        lines.join(dwdate, F.col("lo_orderdate") == F.col("d_datekey"))
        .groupBy("d_year", "p_brand1")
        .agg(F.sum("revenue").alias("revenue"))
    )


def drill(lineorder, dwdate, customer, supplier, cities, year_month) -> DataFrame:
    """Revenue between customer and supplier cities in one month, largest first within a year."""
    month = dwdate.where(F.col("d_yearmonth") == year_month).select("d_datekey", "d_year")
    buyers = customer.where(F.col("c_city").isin(cities)).select("c_custkey", "c_city")
    sellers = supplier.where(F.col("s_city").isin(cities)).select("s_suppkey", "s_city")
    return (
        lineorder.join(sellers, F.col("lo_suppkey") == F.col("s_suppkey"))
        .groupBy("lo_orderdate", "lo_custkey", "s_city")
        .agg(F.sum("lo_revenue").alias("revenue"))
        .join(month, F.col("lo_orderdate") == F.col("d_datekey"))
        .groupBy("lo_custkey", "s_city", "d_year")
        .agg(F.sum("revenue").alias("revenue"))
        .join(buyers, F.col("lo_custkey") == F.col("c_custkey"))
        .groupBy("c_city", "s_city", "d_year")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy("d_year", F.desc("revenue"), "c_city", "s_city")
    )


def drill_orders(lineorder, orders, customer, supplier, cities, year_month) -> DataFrame:
    """``drill`` where the date table is one of orders that also name the customer."""
    month = orders.where(F.col("d_yearmonth") == year_month).select("d_datekey", "d_year", "lo_custkey")
    buyers = customer.where(F.col("c_city").isin(cities)).select("c_custkey", "c_city")
    sellers = supplier.where(F.col("s_city").isin(cities)).select("s_suppkey", "s_city")
    bought = month.join(buyers, F.col("lo_custkey") == F.col("c_custkey"))
    return (
        lineorder.join(sellers, F.col("lo_suppkey") == F.col("s_suppkey"))
        .join(bought, F.col("lo_orderdate") == F.col("d_datekey"))
        .groupBy("c_city", "s_city", "d_year")
        .agg(F.sum("lo_revenue").alias("revenue"))
        .orderBy("d_year", F.desc("revenue"), "c_city", "s_city")
    )


def same_distribution(lineorder, part) -> DataFrame:
    """Discounted revenue per day of the lines whose part is known."""
    return (
        lineorder.join(part, F.col("lo_partkey") == F.col("p_partkey"), "left_semi")
        .groupBy("lo_orderdate")
        .agg(F.sum(_discounted()).alias("revenue"))
        .orderBy("lo_orderdate")
    )


def _discounted():
    return (F.col("lo_extendedprice") * F.col("lo_discount")).cast("decimal(18,0)")
