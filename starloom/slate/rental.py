"""Rental star dimensions, lists, stock and customer reports."""

from pyspark.sql import functions as F

from starloom.functions.keys import add_dense_keys
from starloom.functions.money import net_units, units_to_money
from starloom.operators.aggregate import concat_by
from starloom.plans import rental, rental_star
from starloom.session import read_table
from starloom.slate import query, roles
from starloom.slate.roles import AMOUNT, money

LOAD_DATE = "2024-01-01"
AS_OF = "2000-01-01"

_PLACE = "join nation on {key} = n_nationkey join region on n_regionkey = r_regionkey"


@query("""
select distinct cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_key, cast(o_orderdate as date) as date,
       cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
       cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day,
       cast(week(o_orderdate) as integer) as week, isodow(o_orderdate) in (6, 7) as is_weekend
from orders""")
def dim_date(spark, d):
    return rental_star.dim_date(roles.orders(spark, d), "o_orderdate")


@query(f"""
select c_custkey as customer_key, c_custkey as customer_id, split_part(c_name, '#', 1) as first_name,
       split_part(c_name, '#', 2) as last_name, n_name as city, r_name as country,
       date '{LOAD_DATE}' as start_date, date '{LOAD_DATE}' as end_date
from customer {_PLACE.format(key='c_nationkey')}""")
def dim_customer(spark, d):
    people = roles.customer(spark, d).withColumns(
        {"email": F.lit(None), "active": F.lit(1), "create_date": F.lit(None)}
    )
    return rental_star.dim_customer(people, *roles.place(spark, d), LOAD_DATE).select(
        "customer_key", "customer_id", "first_name", "last_name", "city", "country", "start_date", "end_date"
    )


@query(f"""
select s_suppkey as store_key, s_suppkey as store_id, n_name as city, r_name as country,
       split_part(s_name, '#', 1) as manager_first_name, split_part(s_name, '#', 2) as manager_last_name
from supplier {_PLACE.format(key='s_nationkey')}""")
def dim_store(spark, d):
    stores = rental_star.dim_store(
        roles.store(spark, d), roles.staff(spark, d).drop("address_id", "store_id"), *roles.place(spark, d), LOAD_DATE
    )
    return stores.select("store_key", "store_id", "city", "country", "manager_first_name", "manager_last_name")


@query("""
select p_partkey as movie_key, p_name as title, l.r_name as language, o.r_name as original_language,
       p_size as length, p_type as rating
from part join region l on p_size % 6 = l.r_regionkey
left join region o on case when p_size % 2 = 0 then p_size % 5 end = o.r_regionkey""")
def dim_movie(spark, d):
    """Two roles of one language table: the inner join drops films without a language."""
    movies = rental_star.dim_movie(roles.film(spark, d), roles.language(spark, d))
    return movies.select("movie_key", "title", "language", "original_language", "length", "rating")


@query(f"""
select cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_key, o_custkey as customer_key,
       l_partkey as movie_key, l_suppkey as store_key, cast({AMOUNT} as double) as sales_amount
from lineitem join orders on l_orderkey = o_orderkey""")
def fact_sales(spark, d):
    return roles.sales_fact(spark, d).withColumn("sales_amount", F.col("sales_amount").cast("double") / 10000)


@query("""
select count(*) as rows, min(n) as first_key, max(n) as last_key, count(distinct n) as keys,
    count(distinct o_orderkey) as orders, cast(sum(n) as bigint) as key_sum
from (select o_orderkey, row_number() over (order by o_orderkey) as n from orders)""")
def dense_order_keys(spark, d):
    """Surrogate keys 1..n without a global sort: complete, without repeats, one for each order."""
    keyed = add_dense_keys(roles.orders(spark, d).select("o_orderkey"), "o_orderkey", "n")
    return keyed.agg(
        F.count("*").alias("rows"),
        F.min("n").alias("first_key"),
        F.max("n").alias("last_key"),
        F.count_distinct("n").alias("keys"),
        F.count_distinct("o_orderkey").alias("orders"),
        F.sum("n").alias("key_sum"),
    )


@query(f"""
select c_custkey as id, replace(c_name, '#', ' ') as name, '1 ' || n_name as address,
       lpad(cast(n_nationkey as varchar), 5, '0') as "zip code", '+' || n_nationkey as phone, n_name as city,
       r_name as country, case when c_acctbal > 0 then 'active' else '' end as notes, c_custkey % 2 as sid
from customer {_PLACE.format(key='c_nationkey')}""")
def customer_list(spark, d):
    return rental.customer_list(roles.customer(spark, d), *roles.place(spark, d))


@query(f"""
select s_suppkey as id, replace(s_name, '#', ' ') as name, '1 ' || n_name as address,
       lpad(cast(n_nationkey as varchar), 5, '0') as "zip code", '+' || n_nationkey as phone, n_name as city,
       r_name as country, s_suppkey as sid
from supplier {_PLACE.format(key='s_nationkey')}""")
def staff_list(spark, d):
    return rental.staff_list(roles.staff(spark, d), *roles.place(spark, d))


def _cast(spark, d):
    """Nations that supply a part, as its actors: at most 25 per film."""
    supplied = read_table(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    seller = read_table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("actor_id")
    )
    return supplied.join(seller, "l_suppkey").select(F.col("l_partkey").alias("film_id"), "actor_id").distinct()


def _actors(spark, d):
    """Nations as actors: first and last name are the two parts of the nation's name."""
    return read_table(spark, d, "nation").select(
        F.col("n_nationkey").alias("actor_id"),
        F.element_at(F.split("n_name", "_"), 1).alias("first_name"),
        F.element_at(F.split("n_name", "_"), 2).alias("last_name"),
    )


def _film_list_sql(actor):
    return f"""
with c as (select distinct l_partkey, s_nationkey from lineitem join supplier on l_suppkey = s_suppkey)
select p_partkey as fid, p_name as title, p_brand as category, p_size as length, p_type as rating,
       string_agg({actor}, ', ' order by {actor}) as actors
from part join c on p_partkey = l_partkey join nation on s_nationkey = n_nationkey
group by 1, 2, 3, 4, 5"""


def _films(spark, d, nicer):
    films = rental.film_list(
        roles.category(spark, d),
        roles.film_category(spark, d),
        roles.film(spark, d),
        _cast(spark, d),
        _actors(spark, d),
        nicer,
    )
    return films.select("fid", "title", "category", "length", "rating", "actors")


@query(_film_list_sql("replace(n_name, '_', ' ')"))
def film_list(spark, d):
    return _films(spark, d, nicer=False)


@query(_film_list_sql("'Nation' || split_part(n_name, '_', 2)"))
def nicer_film_list(spark, d):
    return _films(spark, d, nicer=True)


@query("""
with t as (select distinct l_suppkey, p_brand, p_name from lineitem join part on l_partkey = p_partkey),
b as (select l_suppkey, p_brand || ': ' || string_agg(p_name, ', ' order by p_name) as titles
      from t group by l_suppkey, p_brand)
select s_suppkey as actor_id, s_name as first_name, string_agg(titles, ', ' order by titles) as film_info
from supplier left join b on s_suppkey = l_suppkey group by 1, 2""")
def actor_info(spark, d):
    """Suppliers with "brand: titles" of the parts they sold; both lists hold distinct vocabulary only."""
    part = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name")
    sold = read_table(spark, d, "lineitem").select("l_partkey", "l_suppkey").join(part, "l_partkey")
    films = concat_by(sold, ["l_suppkey", "p_brand"], F.col("p_name"), "titles", distinct=True)
    lists = concat_by(films, ["l_suppkey"], F.concat_ws(": ", "p_brand", "titles"), "film_info")
    return (
        read_table(spark, d, "supplier")
        .select(F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("first_name"))
        .join(lists.withColumnRenamed("l_suppkey", "actor_id"), "actor_id", "left")
    )


_OPEN = "(select l_partkey, count(*) filter (where l_linestatus = 'O') as open from lineitem group by 1)"


@query(f"""
select p_partkey as inventory_id, coalesce(open, 0) = 0 as in_stock
from part left join {_OPEN} on p_partkey = l_partkey""")
def in_stock(spark, d):
    return rental.in_stock(roles.inventory(spark, d), roles.stock_rental(spark, d)).select("inventory_id", "in_stock")


@query(f"""
select p_size % 2 as store_id, count(*) as items, count(*) filter (where coalesce(open, 0) > 0) as out
from part left join {_OPEN} on p_partkey = l_partkey group by 1""")
def stock_per_store(spark, d):
    stock = rental.in_stock(roles.inventory(spark, d), roles.stock_rental(spark, d))
    return stock.groupBy("store_id").agg(F.count("*").alias("items"), F.count_if(~F.col("in_stock")).alias("out"))


@query("""
select l_partkey as inventory_id, o_custkey as customer_id
from lineitem join orders on l_orderkey = o_orderkey where l_linestatus = 'O'""")
def held_by(spark, d):
    return rental.held_by_customer(roles.rental(spark, d))


@query(f"""
with r as (
  select o_custkey, 0.99 + p_size % 5 as rate, l_shipdate, l_linestatus, o_orderdate, p_size
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
  where o_orderdate <= date '{AS_OF}'),
f as (
  select o_custkey, sum(rate) as fees,
         sum(case when l_linestatus <> 'O'
             then greatest(datediff('day', o_orderdate, l_shipdate) - (p_size % 7 + 3), 0) else 0 end) as late
  from r group by 1),
p as (
  select o_custkey, sum({AMOUNT}) as paid
  from lineitem join orders on l_orderkey = o_orderkey where l_shipdate <= date '{AS_OF}' group by 1)
select c_custkey as customer_id,
       {money('coalesce(cast(fees as decimal(20,2)), 0) + coalesce(late, 0) - coalesce(paid, 0)')} as balance
from customer left join f on c_custkey = f.o_custkey left join p on c_custkey = p.o_custkey""")
def customer_balance(spark, d):
    """Lines are rentals and their payments at once: lines, orders and parts are read once."""
    part = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    dated = roles.orders(spark, d).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("rental_date")
    )
    lines = read_table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_shipdate").alias("payment_date"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("return_date"),
        (net_units() * F.lit("0.0001").cast("decimal(4,4)")).alias("amount"),
    )
    moves = lines.join(dated, "l_orderkey").join(part, "l_partkey").withColumns(
        {
            "rental_rate": (F.col("p_size") % 5 + F.lit("0.99").cast("decimal(4,2)")).cast("decimal(4,2)"),
            "rental_duration": F.col("p_size") % 7 + 3,
        }
    )
    balance = rental.balances(roles.customer(spark, d), moves, AS_OF)
    return balance.withColumn("balance", F.round("balance", 2).cast("double"))


@query(f"""
select c_custkey as customer_id, c_mktsegment as segment from customer where c_custkey in (
  select o_custkey from lineitem join orders on l_orderkey = o_orderkey
  where l_shipdate >= date '1997-03-01' and l_shipdate < date '1997-04-01'
  group by o_custkey having sum({AMOUNT}) > 50000 and count(*) > 2)""")
def rewards_report(spark, d):
    """More than two purchases and more than 50,000 in the month three months before June 1997."""
    kept = rental.rewards_report(roles.customer(spark, d), roles.payment(spark, d), 2, 500_000_000, "1997-06-15")
    return kept.select("customer_id", "segment")


@query(f"""
select cast(month(l_shipdate) as integer) as month, {money(f'sum({AMOUNT})')} as revenue
from lineitem group by 1""")
def payment_by_month(spark, d):
    paid = roles.lines(spark, d, F.col("l_shipdate").alias("payment_date"))
    return rental.revenue_by_month(paid).withColumn("revenue", units_to_money(F.col("revenue")))
