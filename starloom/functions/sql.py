"""User functions for SQL text.

Scalar and table functions have SQL bodies, which Spark inlines into the plan.
The one Python function works on Arrow batches.
"""

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

SCALAR_FUNCTIONS = {
    "get_hour": "(ts bigint) returns int return hour(timestamp_millis(ts))",
    "day_key": "(d date) returns int return year(d) * 10000 + month(d) * 100 + day(d)",
    "days_late": "(rented date, returned date, allowed int) returns int"
    " return greatest(datediff(returned, rented) - allowed, 0)",
}

# Need the views ``inventory`` and ``rental``, the report ``customer`` and ``payment``.
STOCK = """
  select i.inventory_id from inventory i left anti join
    (select inventory_id from rental where return_date is null) o on i.inventory_id = o.inventory_id
  where i.film_id = p_film and i.store_id = p_store"""
TABLE_FUNCTIONS = {
    "film_in_stock": f"(p_film int, p_store int) returns table (inventory_id int) return {STOCK}",
    "film_not_in_stock": f"(p_film int, p_store int) returns table (inventory_id int) return"
    f" {STOCK.replace('left anti', 'left semi')}",
    "rewards_report": "(p_purchases int, p_amount decimal(20,4), p_as_of date) returns table (customer_id bigint)"
    """ return select c.customer_id from customer c left semi join (
      select customer_id from payment
      where payment_date >= trunc(add_months(p_as_of, -3), 'month') and payment_date < trunc(add_months(p_as_of, -2), 'month')
      group by customer_id having sum(amount) > p_amount and count(*) > p_purchases) s on c.customer_id = s.customer_id""",
}


def register_views(**tables: DataFrame) -> None:
    """Name DataFrames for use in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_functions(spark: SparkSession, names=SCALAR_FUNCTIONS) -> None:
    for name in names:
        body = SCALAR_FUNCTIONS.get(name) or TABLE_FUNCTIONS[name]
        spark.sql(f"create or replace temporary function {name}{body}")


def page_flag(page: str):
    """Typed Python function: 1 for a page, else 0. ``F.col("page") == page`` does the same without Python."""

    @F.pandas_udf("int")
    def flag(pages: pd.Series) -> pd.Series:
        return (pages == page).astype("int32")

    return flag
