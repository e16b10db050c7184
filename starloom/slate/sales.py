"""Revenue reports."""

from pyspark.sql import functions as F

from starloom.functions.money import cents_to_money, hundredths, units_to_money
from starloom.operators.aggregate import (
    covered_period,
    facts_summary,
    group_count,
    having_totals,
    table_counts,
    top_k,
    top_with_ties,
)
from starloom.operators.joins import join_chain
from starloom.plans import shop
from starloom.session import read_table
from starloom.slate import query
from starloom.slate.roles import AMOUNT, amounts_by, lines, money, orders


def _money(df, name="revenue"):
    return df.withColumn(name, units_to_money(F.col(name)))


@query(f"""
select p_name as title, {money(f'sum({AMOUNT})')} as revenue
from lineitem join part on l_partkey = p_partkey
group by p_name order by sum({AMOUNT}) desc, p_name limit 10""")
def top_parts_revenue(spark, d):
    """Ten titles with the highest revenue."""
    part = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("title"))
    sold = amounts_by(spark, d, "l_partkey").join(part, "l_partkey")
    return _money(top_k(sold.groupBy("title").agg(F.sum("amount").alias("revenue")), "revenue", 10, "title"))


def _customer_amounts(spark, d):
    """Net amount per customer: per order first, so that both joins meet one row per key."""
    owner = orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    per_order = amounts_by(spark, d, "l_orderkey").join(owner, "l_orderkey")
    return per_order.groupBy("c_custkey").agg(F.sum("amount").alias("amount"))


@query(f"""
select n_name as city, {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
group by n_name order by sum({AMOUNT}) desc, n_name limit 10""")
def top_nations_revenue(spark, d):
    """Ten cities with the highest revenue."""
    by_nation = (
        _customer_amounts(spark, d)
        .join(read_table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
        .groupBy("c_nationkey")
        .agg(F.sum("amount").alias("amount"))
    )
    nation = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    totals = by_nation.join(nation, "c_nationkey").groupBy("city").agg(F.sum("amount").alias("revenue"))
    return _money(top_k(totals, "revenue", 10, "city"))


@query(f"""
select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
       {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey group by 1, 2""")
def revenue_by_month(spark, d):
    sold = orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate"))
    return _money(
        amounts_by(spark, d, "l_orderkey")
        .join(sold, "l_orderkey")
        .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .agg(F.sum("amount").alias("revenue"))
    )


@query(f"""
select p_name as title, n_name as city, cast(month(o_orderdate) as integer) as month,
       {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by 1, 2, 3""")
def revenue_part_nation_month(spark, d):
    """Title x city x month. Orders, fewer than lines, meet the customers first; nations are named after the sum."""
    part = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("title"))
    sold = orders(spark, d).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), F.month("o_orderdate").alias("month")
    )
    buyer = read_table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nation = read_table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    titled = lines(spark, d, "l_orderkey", "l_partkey").join(part, "l_partkey")
    per_nation = (
        titled.join(sold.join(buyer, "c_custkey"), "l_orderkey")
        .groupBy("title", "n_nationkey", "month")
        .agg(F.sum("amount").alias("amount"))
    )
    return _money(
        per_nation.join(nation, "n_nationkey").groupBy("title", "city", "month").agg(F.sum("amount").alias("revenue"))
    )


@query(f"""
select p_brand as category, {money(f'sum({AMOUNT})')} as total_sales
from lineitem join part on l_partkey = p_partkey group by p_brand""")
def sales_by_category(spark, d):
    part = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("category"))
    sold = amounts_by(spark, d, "l_partkey").join(part, "l_partkey")
    return _money(sold.groupBy("category").agg(F.sum("amount").alias("total_sales")), "total_sales")


@query(f"""
select n_name || ',' || r_name as store, s_name as manager, {money(f'sum({AMOUNT})')} as total_sales
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
join region on n_regionkey = r_regionkey group by 1, 2""")
def sales_by_store(spark, d):
    place = (
        read_table(spark, d, "nation")
        .join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("s_nationkey"), F.concat_ws(",", "n_name", "r_name").alias("store"))
    )
    seller = read_table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey", F.col("s_name").alias("manager")
    )
    sold = amounts_by(spark, d, "l_suppkey").join(seller, "l_suppkey").join(place, "s_nationkey")
    return _money(sold.groupBy("store", "manager").agg(F.sum("amount").alias("total_sales")), "total_sales")


@query("""
select c_name as name, p_name as item_name, n_name as state, o_totalprice as spent
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
join lineitem on l_orderkey = o_orderkey join part on l_partkey = p_partkey
where o_totalprice > 400000 and l_quantity > 40""")
def large_purchases(spark, d):
    """Who spent more than a limit, on what, where."""
    big = orders(spark, d).where("o_totalprice > 400000").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("spent")
    )
    lines_ = read_table(spark, d, "lineitem").where("l_quantity > 40")
    items = lines_.select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    buyers = read_table(spark, d, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_nationkey").alias("n_nationkey")
    )
    titles = read_table(spark, d, "part").select("p_partkey", F.col("p_name").alias("item_name"))
    states = read_table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    return join_chain(
        items, (big, "l_orderkey"), (buyers, "c_custkey"), (titles, "p_partkey"), (states, "n_nationkey")
    ).select("name", "item_name", "state", "spent")


@query("""
select o_orderpriority as cashier_name, cast(sum(cast(o_totalprice as decimal(14,2))) as double) as total
from orders group by 1""")
def cashier_sales(spark, d):
    """Totals per cashier of a denormalised sales table."""
    paid = orders(spark, d).select(
        F.col("o_orderpriority").alias("cashier_name"), hundredths("o_totalprice").cast("decimal(18,0)").alias("spent")
    )
    return paid.groupBy("cashier_name").agg(cents_to_money(F.sum("spent")).alias("total"))


@query("""
select l_suppkey, max(l_quantity) as max_l_quantity, min(l_quantity) as min_l_quantity,
       avg(l_quantity) as average_l_quantity
from lineitem group by l_suppkey""")
def facts_summary_supplier(spark, d):
    return facts_summary(read_table(spark, d, "lineitem"), "l_quantity", "l_suppkey")


@query("""
select p_name, avg(p_size) as average from part
where p_retailprice between 950 and 1400 and p_name like '%ring%' group by p_name order by p_name limit 20""")
def average_by_title(spark, d):
    """Average by title under a range and a pattern, first titles in order."""
    part = read_table(spark, d, "part")
    kept = part.where(F.col("p_retailprice").between(950, 1400) & F.col("p_name").like("%ring%"))
    return kept.groupBy("p_name").agg(F.avg("p_size").alias("average")).orderBy("p_name").limit(20)


@query("""
select o_custkey, cast(sum(cast(o_totalprice as decimal(14,2))) as double) as total, count(*) as purchases
from orders group by o_custkey having sum(cast(o_totalprice as decimal(14,2))) > 2500000 and count(*) > 8""")
def customers_having_totals(spark, d):
    """Groups above a sum and a count."""
    spent = orders(spark, d).withColumn("cents", hundredths("o_totalprice").cast("decimal(18,0)"))
    kept = having_totals(spent, "o_custkey", "cents", 8, 250000000)
    return kept.withColumn("total", cents_to_money(F.col("total")))


@query("""
select n_name as district, count(*) as n from customer join nation on c_nationkey = n_nationkey
group by 1 order by n desc, district limit 10""")
def top_districts(spark, d):
    """Districts with the most customers; counted by key before the name is looked up."""
    counts = group_count(read_table(spark, d, "customer"), "c_nationkey", name="n")
    nation = read_table(spark, d, "nation")
    named = counts.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return top_k(named.groupBy(F.col("n_name").alias("district")).agg(F.sum("n").alias("n")), "n", 10, "district")


@query("""
with q as (select l_partkey, cast(sum(l_quantity) as bigint) as quantity from lineitem group by 1)
select l_partkey, quantity from q where quantity = (select max(quantity) from q)""")
def top_part_with_ties(spark, d):
    quantity = read_table(spark, d, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )
    return top_with_ties(quantity, "quantity")


@query("""
select 'region' as "table", count(*) as records from region union all select 'nation', count(*) from nation
union all select 'customer', count(*) from customer union all select 'supplier', count(*) from supplier
union all select 'part', count(*) from part union all select 'orders', count(*) from orders
union all select 'lineitem', count(*) from lineitem union all select 'events', count(*) from events
union all select 'documents', count(*) from documents union all select 'embeddings', count(*) from embeddings
union all select 'pages', count(*) from pages union all select 'benchmark', count(*) from benchmark
union all select 'labels', count(*) from labels union all select 'conversations', count(*) from conversations""")
def table_counts_all(spark, d):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    names += ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    return table_counts({name: read_table(spark, d, name) for name in names})


@query('select min(o_orderdate) as "first", max(o_orderdate) as "last" from orders')
def period_covered(spark, d):
    return covered_period(orders(spark, d), "o_orderdate")


@query("""
select o_orderkey, o_orderdate, o_totalprice from orders
where o_orderstatus = 'P' and o_orderpriority like '%HIGH%'
  and o_orderdate >= date '1998-01-01' and o_orderdate <= date '1998-12-31'""")
def filter_like_range(spark, d):
    """Equality, pattern and date range; equality and range reach the Parquet scan."""
    priority = F.col("o_orderpriority").like("%HIGH%")
    kept = orders(spark, d).where("o_orderstatus = 'P'").where("o_orderdate >= '1998-01-01' and o_orderdate <= '1998-12-31'")
    return kept.where(priority).select("o_orderkey", "o_orderdate", "o_totalprice")


@query("select p_brand as album_name, cast(sum(p_size) as bigint) as album_length from part group by 1")
def album_lengths(spark, d):
    """Total length per album of a denormalised song table."""
    songs = read_table(spark, d, "part").select(F.col("p_brand").alias("album_name"), F.col("p_size").alias("song_length"))
    return shop.album_lengths(songs)


@query("""
select o_custkey % 100 as store_id, cast(sum(cast(o_totalprice as decimal(14,2))) as double) as spent
from orders group by 1""")
def sales_per_store(spark, d):
    paid = orders(spark, d).select(
        (F.col("o_custkey") % 100).alias("store_id"), hundredths("o_totalprice").cast("decimal(18,0)").alias("spent")
    )
    return shop.sales_per_store(paid).withColumn("spent", cents_to_money(F.col("spent")))
