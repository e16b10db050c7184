"""Rental database to stored star tables to a stored cube, lot by lot.

A lot is what was paid in some days. Loading it appends its sales to the fact
table and folds its cells into the cube: sums and counts per finest cell, kept
in buckets of days, so that only the days of the lot are read and written. Lots
are numbered; one that is repeated after a failure at any point adds nothing
twice.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.operators import cubes
from starloom.operators.keyed_state import fold
from starloom.operators.snapshots import newest, publish, read_state, stage
from starloom.operators.writes import load_table
from starloom.plans import rental_star

#: The finest cells of the stored cube.
CELL = ["date_key", "rating", "city", "country"]
_CELLS = "date_key int, rating string, city string, country string, revenue decimal(38,4), sales bigint"


def load_dimensions(tables: dict, root: str, load_date) -> None:
    """Write the four dimension tables from the tables of the rental database."""
    place = tables["address"], tables["city"], tables["country"]
    dimensions = {
        "dim_customer": rental_star.dim_customer(tables["customer"], *place, load_date),
        "dim_movie": rental_star.dim_movie(tables["film"], tables["language"]),
        "dim_store": rental_star.dim_store(tables["store"], tables["staff"], *place, load_date),
        "dim_date": rental_star.dim_date(tables["payment"], "payment_date"),
    }
    for name, rows in dimensions.items():
        load_table(rows, f"{root}/{name}")


def read_star(spark: SparkSession, root: str) -> dict:
    return {name: read_state(spark, f"{root}/{name}") for name in ("dim_customer", "dim_movie", "dim_store", "dim_date", "fact_sales")}


def load_sales_lot(payment: DataFrame, tables: dict, root: str, number: int, buckets=64) -> None:
    """Append the sales of the payments of one lot and fold them into the cube."""
    spark, path, part = payment.sparkSession, f"{root}/fact_sales", f"lot{number}"
    state = newest(spark, path)
    parts = dict(state.parts) if state else {}
    if part not in parts:
        folder = stage(rental_star.fact_sales(payment, tables["rental"], tables["inventory"]), path)
        publish(spark, path, state.number + 1 if state else 0, {**parts, part: folder})
    sold = read_state(spark, path, names=[part])
    empty = spark.createDataFrame([], _CELLS)
    merge = lambda cells, more: cubes.merge_cells(cells, more, CELL)
    fold(f"{root}/cube", number, day_cells(spark, root, sold), empty, ["date_key"], merge, buckets)


def day_cells(spark: SparkSession, root: str, sold: DataFrame) -> DataFrame:
    """Finest cells of sales, with the star's dimensions."""
    movie = read_state(spark, f"{root}/dim_movie").select("movie_key", "rating")
    customer = read_state(spark, f"{root}/dim_customer").select("customer_key", "city", "country")
    star = sold.join(movie, "movie_key").join(customer, "customer_key")
    return cubes.partial_cells(star.withColumn("sales_amount", F.col("sales_amount").cast("decimal(28,4)")), CELL, "sales_amount")


def cube(spark: SparkSession, root: str) -> DataFrame:
    """The cells of the stored cube."""
    return read_state(spark, f"{root}/cube")
