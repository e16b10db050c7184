"""The given tables in the roles of the data model."""

from pyspark.sql import DataFrame, functions as F

from starloom.functions.money import hundredths, net_units
from starloom.session import read_table

# SQL for the net amount of a line, for the oracles.
AMOUNT = "(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))))"


def money(expression: str) -> str:
    return f"cast(round({expression}, 2) as double)"


def lines(spark, d, *columns) -> DataFrame:
    """Order lines with their net amount in ten-thousandths."""
    return read_table(spark, d, "lineitem").select(*columns, net_units().alias("amount"))


def amounts_by(spark, d, *columns) -> DataFrame:
    """Net amounts summed per line key before any join."""
    return lines(spark, d, *columns).groupBy(*columns).agg(F.sum("amount").alias("amount"))


def orders(spark, d) -> DataFrame:
    return read_table(spark, d, "orders")


def customer(spark, d) -> DataFrame:
    """Customers of the rental model; the address is the nation."""
    return read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.element_at(F.split("c_name", "#"), 1).alias("first_name"),
        F.element_at(F.split("c_name", "#"), 2).alias("last_name"),
        F.col("c_nationkey").alias("address_id"),
        F.col("c_mktsegment").alias("segment"),
        (F.col("c_acctbal") > 0).alias("activebool"),
        (F.col("c_custkey") % 2).alias("store_id"),
        hundredths("c_acctbal").alias("balance_cents"),
    )


def staff(spark, d) -> DataFrame:
    """Suppliers as staff of their own store."""
    return read_table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("staff_id"),
        F.element_at(F.split("s_name", "#"), 1).alias("first_name"),
        F.element_at(F.split("s_name", "#"), 2).alias("last_name"),
        F.col("s_nationkey").alias("address_id"),
        F.col("s_suppkey").alias("store_id"),
    )


def store(spark, d) -> DataFrame:
    return read_table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_suppkey").alias("manager_staff_id"),
        F.col("s_nationkey").alias("address_id"),
    )


def address(spark, d) -> DataFrame:
    return read_table(spark, d, "nation").select(
        F.col("n_nationkey").alias("address_id"),
        F.concat(F.lit("1 "), "n_name").alias("address"),
        F.lit(None).cast("string").alias("address2"),
        F.col("n_name").alias("district"),
        F.col("n_nationkey").alias("city_id"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("postal_code"),
        F.concat(F.lit("+"), F.col("n_nationkey").cast("string")).alias("phone"),
        F.lit(None).cast("timestamp").alias("last_update"),
    )


def city(spark, d) -> DataFrame:
    return read_table(spark, d, "nation").select(
        F.col("n_nationkey").alias("city_id"),
        F.col("n_name").alias("city"),
        F.col("n_regionkey").alias("country_id"),
        F.lit(None).cast("timestamp").alias("last_update"),
    )


def country(spark, d) -> DataFrame:
    return read_table(spark, d, "region").select(
        F.col("r_regionkey").alias("country_id"),
        F.col("r_name").alias("country"),
        F.lit(None).cast("timestamp").alias("last_update"),
    )


def place(spark, d):
    return address(spark, d), city(spark, d), country(spark, d)


def brand_number(column="p_brand"):
    return F.element_at(F.split(column, "#"), 2).cast("int")


def film(spark, d) -> DataFrame:
    return read_table(spark, d, "part").select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("description"),
        (F.col("p_size") % 6).alias("language_id"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size") % 5).alias("original_language_id"),
        (F.lit(1995) + F.col("p_size") % 7).alias("release_year"),
        (F.col("p_size") % 7 + 3).alias("rental_duration"),
        (F.col("p_size") % 5 + F.lit("0.99").cast("decimal(4,2)")).cast("decimal(4,2)").alias("rental_rate"),
        F.col("p_size").alias("length"),
        F.col("p_type").alias("rating"),
        F.array("p_brand", "p_type").alias("special_features"),
    )


def film_category(spark, d) -> DataFrame:
    return read_table(spark, d, "part").select(F.col("p_partkey").alias("film_id"), brand_number().alias("category_id"))


def category(spark, d) -> DataFrame:
    return (
        read_table(spark, d, "part").select(brand_number().alias("category_id"), F.col("p_brand").alias("name")).distinct()
    )


def language(spark, d) -> DataFrame:
    return read_table(spark, d, "region").select(
        F.col("r_regionkey").alias("language_id"), F.col("r_name").alias("name")
    )


def inventory(spark, d) -> DataFrame:
    """One copy of every part."""
    return read_table(spark, d, "part").select(
        F.col("p_partkey").alias("inventory_id"),
        F.col("p_partkey").alias("film_id"),
        (F.col("p_size") % 2).alias("store_id"),
    )


def stock_rental(spark, d) -> DataFrame:
    """Lines as rentals of their part; a line of status O is not returned yet."""
    return read_table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("inventory_id"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("return_date"),
        "l_orderkey",
    )


def rental(spark, d) -> DataFrame:
    """Stock rentals with their customer and rental date."""
    dated = orders(spark, d).select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("rental_date"),
    )
    return stock_rental(spark, d).join(dated, "l_orderkey").drop("l_orderkey")


def payment(spark, d) -> DataFrame:
    """Lines as payments of the order's customer."""
    payer = orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    return lines(spark, d, "l_orderkey", F.col("l_shipdate").alias("payment_date")).join(payer, "l_orderkey")


# A line has no key of its own: all that tells it from others is its rental's.
_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]


def line_rental(spark, d) -> DataFrame:
    """Lines as rentals of the one copy of their part."""
    return read_table(spark, d, "lineitem").select(
        F.xxhash64(*_LINE).alias("rental_id"), F.col("l_partkey").alias("inventory_id")
    )


def line_payment(spark, d) -> DataFrame:
    """Lines as payments of their rental by the order's customer, on the day of the order; money in ten-thousandths."""
    payer = orders(spark, d).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("payment_date")
    )
    paid = read_table(spark, d, "lineitem").select(F.xxhash64(*_LINE).alias("rental_id"), "l_orderkey", net_units().alias("amount"))
    return paid.join(payer, "l_orderkey").select("rental_id", "customer_id", "payment_date", "amount")


def rental_tables(spark, d) -> dict:
    """The rental database: the given tables in all its roles."""
    people = customer(spark, d).withColumns({"email": F.lit(None).cast("string"), "active": F.lit(1), "create_date": F.lit(None).cast("date")})
    return {
        "customer": people,
        "address": address(spark, d),
        "city": city(spark, d),
        "country": country(spark, d),
        "film": film(spark, d),
        "language": language(spark, d),
        "film_category": film_category(spark, d),
        "category": category(spark, d),
        "inventory": inventory(spark, d),
        "store": store(spark, d),
        "staff": staff(spark, d).drop("address_id", "store_id"),
        "rental": line_rental(spark, d),
        "payment": line_payment(spark, d),
    }


def sales_fact(spark, d) -> DataFrame:
    """Sales star fact: one row per line, keyed by order day, customer, part and supplier."""
    from starloom.functions.dates import date_key

    sold = orders(spark, d).select(
        F.col("o_orderkey").alias("l_orderkey"),
        date_key("o_orderdate").alias("date_key"),
        F.col("o_custkey").alias("customer_key"),
    )
    return (
        lines(spark, d, "l_orderkey", F.col("l_partkey").alias("movie_key"), F.col("l_suppkey").alias("store_key"))
        .join(sold, "l_orderkey")
        .select("date_key", "customer_key", "movie_key", "store_key", F.col("amount").alias("sales_amount"))
    )
