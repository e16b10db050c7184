"""Data-quality reports."""

from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.session import read_table
from starloom.slate import query


@query("""
with r as (
  select 'orders: has rows' as "check", case when count(*) = 0 then 1 else 0 end as failed from orders
  union all select 'orders: o_orderkey not null', count(*) filter (where o_orderkey is null) from orders
  union all select 'orders: o_custkey not null', count(*) filter (where o_custkey is null) from orders
  union all select 'orders: o_orderstatus in domain', count(*) filter (where o_orderstatus not in ('F', 'O')) from orders
  union all select 'orders: o_totalprice in range', count(*) filter (where o_totalprice not between 1000 and 400000) from orders
  union all select 'orders: o_orderkey unique', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)
  union all select 'lineitem: l_orderkey, l_linenumber unique', count(*)
    from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
  union all select 'orders: o_custkey in parent', count(*) from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)
  union all select 'events: count', case when count(*) = 5 then 1 else 0 end from events)
select "check", cast(failed as bigint) as failed, failed = 0 as passed from r""")
def dq_report(spark, d):
    """Rows, NULLs, domains, ranges, keys, parents and an expected value, as one report."""
    orders = read_table(spark, d, "orders")
    lines = read_table(spark, d, "lineitem")
    solvent = read_table(spark, d, "customer").where("c_acctbal > 0")
    few = read_table(spark, d, "events").agg((F.count("*") == 5).alias("few"))
    return quality.all_checks(
        quality.check_rows(orders, "orders"),
        quality.check_columns(
            orders,
            "orders",
            quality.not_null("o_orderkey", "o_custkey")
            | quality.in_values("o_orderstatus", ["F", "O"])
            | quality.in_range("o_totalprice", 1000, 400000),
        ),
        quality.check_unique(orders, "orders", ["o_orderkey"]),
        quality.check_unique(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
        quality.check_foreign_key(orders, "o_custkey", solvent, "c_custkey", "orders"),
        quality.check_expected([("events: count", few, False)]),
    )


@query("""
select 'orders' as "check", count(*) as records, count(*) > 0 as passed from orders
union all select 'large orders', count(*), count(*) > 0 from orders where o_totalprice > 1e12""")
def count_report(spark, d):
    """Counts with pass or fail, without stopping."""
    orders = read_table(spark, d, "orders")
    return quality.count_report({"orders": orders, "large orders": orders.where("o_totalprice > 1e12")})


@query("""
select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1""")
def repeated_keys(spark, d):
    """Values of a key that occur more than once."""
    lines = read_table(spark, d, "lineitem")
    return lines.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).where("copies > 1")
