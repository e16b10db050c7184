"""Queries on stored tables: query tables, layouts, stored cubes, table functions."""

import uuid

from pyspark.sql import functions as F

from starloom.functions import sql
from starloom.functions.money import units_to_money
from starloom.operators import cubes
from starloom.operators.layout import bucket_count, write_bucketed
from starloom.operators.writes import write_csv
from starloom.plans import query_tables, rental, rental_warehouse
from starloom.session import read_table, work_folder
from starloom.slate import query, roles
from starloom.slate.roles import AMOUNT, money
from starloom.sources import files

# Event history: daily files to one file set to one stored table per question.


def _history(spark, d):
    """The folder of the three stored tables, and the keys of the first event to look up."""
    folder = work_folder(spark, "history")
    k = F.from_json("props", "k int")["k"]
    who = F.col("user_id").cast("string")
    daily = read_table(spark, d, "events").select(
        F.when(F.col("event_type") != "error", F.concat(F.lit("Artist "), (k % 25).cast("string"))).alias("artist"),
        F.concat(F.lit("First"), (F.col("user_id") % 13).cast("string")).alias("firstName"),
        F.lit("F").alias("gender"),
        (F.col("event_id") % 50).alias("itemInSession"),
        F.concat(F.lit("Last"), (F.col("user_id") % 17).cast("string")).alias("lastName"),
        F.col("event_id").alias("length"),
        F.lit("free").alias("level"),
        F.lit("x").alias("location"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("sessionId"),
        F.concat(F.lit("Song "), F.floor(k / 2).cast("string")).alias("song"),
        who.alias("userId"),
    )
    write_csv(daily, f"{folder}/daily")
    query_tables.write_history(query_tables.event_history(spark, f"{folder}/daily"), f"{folder}/all")
    query_tables.store_tables(query_tables.event_history(spark, f"{folder}/all"), folder, ["length"])
    place = F.struct("sessionId", "itemInSession", F.col("userId").cast("int").alias("userId"), "song")
    return folder, daily.where("artist is not null").agg(F.min_by(place, "length").alias("key")).first()["key"]


_HISTORY = """
with h as (
  select 'Artist ' || (cast(json_extract(props, '$.k') as integer) % 25) as artist,
         'Song ' || (cast(json_extract(props, '$.k') as integer) // 2) as song, event_id,
         cast(user_id * 100 + day(ts) as integer) as session, cast(event_id % 50 as integer) as item, cast(user_id as integer) as who,
         'First' || (user_id % 13) || ' ' || 'Last' || (user_id % 17) as name
  from events where event_type <> 'error'),
k as (select * from h order by event_id limit 1)
"""


@query(_HISTORY + """
select arg_max(h.artist, h.event_id) as artist, arg_max(h.song, h.event_id) as song, cast(max(h.event_id) as double) as length
from h, k where h.session = k.session and h.item = k.item group by h.session, h.item""")
def session_item_lookup(spark, d):
    """Song of an item of a session, from a stored table; row groups without the session are not read."""
    folder, key = _history(spark, d)
    found = query_tables.session_item(spark, folder, key["sessionId"], key["itemInSession"])
    return found.withColumn("length", F.col("length").cast("double"))


@query(_HISTORY + """
select h.item as "itemInSession", arg_max(h.artist, h.event_id) as artist, arg_max(h.song, h.event_id) as song,
       arg_max(h.name, h.event_id) as user_name
from h, k where h.session = k.session and h.who = k.who group by h.item order by 1""")
def user_session_lookup(spark, d):
    """Songs of a user's session in the order played, from a stored table."""
    folder, key = _history(spark, d)
    return query_tables.user_session(spark, folder, key["userId"], key["sessionId"])


@query(_HISTORY + """
select h.who as "userId", arg_max(h.name, h.event_id) as user_name from h, k where h.song = k.song group by h.who""")
def song_listeners_lookup(spark, d):
    """Users who heard a song, from a stored table."""
    folder, key = _history(spark, d)
    return query_tables.song_users(spark, folder, key["song"])


# Layouts


def _bucketed(spark, label, key, **tables):
    """Tables of ``name -> (frame, key column)`` in as many buckets as the largest needs."""
    folder, mark = work_folder(spark, label), uuid.uuid4().hex
    buckets = bucket_count(*[df for df, _ in tables.values()])
    return [
        write_bucketed(df, f"{name}_{mark}", buckets, column, path=f"{folder}/{name}") for name, (df, column) in tables.items()
    ]


@query("""
select l_partkey as part, p_name as title, cast(sum(l_quantity) as bigint) as quantity, count(*) as lines
from lineitem join part on l_partkey = p_partkey group by 1, 2""")
def colocated_part_sales(spark, d):
    """Lines and parts bucketed on the part: joined and summed without a shuffle."""
    lines = read_table(spark, d, "lineitem").select("l_partkey", "l_quantity")
    part = read_table(spark, d, "part").select("p_partkey", "p_name")
    lines, part = _bucketed(spark, "by-part", "part", lines=(lines, "l_partkey"), parts=(part, "p_partkey"))
    per_part = lines.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.count("*").alias("lines"))
    return per_part.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").alias("part"), F.col("p_name").alias("title"), "quantity", "lines"
    )


@query("""
select o_orderkey, o_custkey, cast(sum(l_quantity) as bigint) as quantity, max(l_shipdate) as last_shipped
from orders join lineitem on o_orderkey = l_orderkey where l_returnflag <> 'R' group by 1, 2""")
def colocated_order_lines(spark, d):
    """Orders and lines bucketed on the order: joined and summed without a shuffle."""
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate", "l_returnflag")
    orders, lines = _bucketed(spark, "by-order", "order", orders=(orders, "o_orderkey"), lines=(lines, "l_orderkey"))
    met = orders.join(lines.where("l_returnflag <> 'R'"), F.col("o_orderkey") == F.col("l_orderkey"))
    return met.groupBy("o_orderkey", "o_custkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.max("l_shipdate").alias("last_shipped")
    )


@query("select event_id, user_id, event_type from events")
def stage_csv_after_headers(spark, d):
    """Files with three header lines each, read in blocks; lines are skipped by count, not by content."""
    folder = work_folder(spark, "headers")
    events = read_table(spark, d, "events").select("event_id", "user_id", "event_type")
    line = F.concat_ws(";", "event_id", "user_id", "event_type").alias("value")
    lines = events.select(F.pmod("event_id", F.lit(4)).alias("file"), F.lit(1).alias("place"), line)
    # A header line looks like a row: only its place tells it from one.
    head = F.format_string("%d;0;header", F.col("id")).alias("value")
    heads = spark.range(12).select(F.pmod("id", F.lit(4)).alias("file"), F.lit(0).alias("place"), head)
    ordered = heads.unionByName(lines).repartition("file").sortWithinPartitions("file", "place")
    ordered.select("file", "value").write.partitionBy("file").text(folder)
    schema = "event_id long, user_id long, event_type string"
    return files.stage_csv(spark, f"{folder}/*", schema, sep=";", skip_lines=3)


# Table functions


# Few lines are rentals that are still out, so that some films are in stock.
_STILL_OUT = "l_linestatus = 'O' and l_linenumber = 1 and l_quantity > 25"


def _stock_views(spark, d):
    stock = roles.inventory(spark, d).withColumn("inventory_id", F.col("inventory_id").cast("int"))
    sql.register_views(
        inventory=stock.withColumns({c: F.col(c).cast("int") for c in ("film_id", "store_id")}),
        rental=read_table(spark, d, "lineitem").select(
            F.col("l_partkey").cast("int").alias("inventory_id"), F.when(~F.expr(_STILL_OUT), F.col("l_shipdate")).alias("return_date")
        ),
        wanted=read_table(spark, d, "part").where("p_size > 20").select(
            F.col("p_partkey").cast("int").alias("film"), (F.col("p_size") % 2).cast("int").alias("store")
        ),
    )


_OUT = f"exists (select 1 from lineitem where l_partkey = p_partkey and {_STILL_OUT})"


@query(f"""
select cast(p_partkey as integer) as film, cast(p_size % 2 as integer) as store, cast(p_partkey as integer) as inventory_id
from part where p_size > 20 and not {_OUT}""")
def films_in_stock(spark, d):
    """A table function called for every row of a table of films and stores; Spark turns the calls into joins."""
    _stock_views(spark, d)
    sql.register_functions(spark, ["film_in_stock"])
    return spark.sql("select film, store, inventory_id from wanted, lateral film_in_stock(film, store)")


@query(f"""
select cast(p_partkey as integer) as film, cast(p_size % 2 as integer) as store, cast(p_partkey as integer) as inventory_id
from part where p_size > 20 and {_OUT}""")
def films_not_in_stock(spark, d):
    _stock_views(spark, d)
    sql.register_functions(spark, ["film_not_in_stock"])
    return spark.sql("select film, store, inventory_id from wanted, lateral film_not_in_stock(film, store)")


@query(f"""
select c_custkey as customer_id, c_mktsegment as segment from customer where c_custkey in (
  select o_custkey from lineitem join orders on l_orderkey = o_orderkey
  where o_orderdate >= date '1997-03-01' and o_orderdate < date '1997-04-01'
  group by o_custkey having sum({AMOUNT}) > 50000 and count(*) > 2)""")
def rewards_report_function(spark, d):
    """The report as a table function: thresholds and date are its arguments."""
    tables = roles.rental_tables(spark, d)
    paid = tables["payment"].withColumn("amount", (F.col("amount") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(22,4)"))
    sql.register_views(customer=tables["customer"], payment=paid)
    sql.register_functions(spark, ["rewards_report"])
    return spark.sql("select customer_id, segment from rewards_report(2, 50000, date'1997-06-15') join customer using (customer_id)")


# From the rental database to stored star tables to a stored cube


def _warehouse(spark, d):
    """Star and cube, loaded in two lots of payments; the first is loaded again, as after a failure."""
    root, tables = work_folder(spark, "warehouse"), roles.rental_tables(spark, d)
    rental_warehouse.load_dimensions(tables, root, "2024-01-01")
    old = F.col("payment_date") < F.lit("1998-01-01").cast("timestamp")
    for number, lot in ((0, old), (1, ~old), (1, ~old)):
        rental_warehouse.load_sales_lot(tables["payment"].where(lot), tables, root, number)
    return root


_CELL = "cast(strftime(o_orderdate, '%Y%m%d') as integer)"
_SALES = """
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where p_size % 6 < 5"""  # Films without a language are not in the star.


@query(f"""
select {_CELL} as date_key, p_type as rating, n_name as city, r_name as country, {money(f'sum({AMOUNT})')} as revenue,
       count(*) as sales {_SALES} group by 1, 2, 3, 4""")
def stored_cube_cells(spark, d):
    """The finest cells of a cube that was kept by merging the cells of lots."""
    return _money(rental_warehouse.cube(spark, _warehouse(spark, d)))


@query(f"""
select cast(year(o_orderdate) as integer) as year, r_name as country, {money(f'sum({AMOUNT})')} as revenue, count(*) as sales
{_SALES} group by 1, 2""")
def stored_cube_years(spark, d):
    """The stored cube rolled up to year and country with the star's date table."""
    root = _warehouse(spark, d)
    days = rental_warehouse.read_star(spark, root)["dim_date"].select("date_key", "year")
    cells = rental_warehouse.cube(spark, root).join(days, "date_key")
    return _money(cubes.coarser(cells, ["year", "country"]).drop("average_sale"))


@query(f"""
select {_CELL} as date_key, o_custkey as customer_key, l_partkey as movie_key, cast(p_size % 2 as integer) as store_key,
       cast({AMOUNT} as double) as sales_amount
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""")
def stored_fact_sales(spark, d):
    """The fact table as loaded in lots."""
    fact = rental_warehouse.read_star(spark, _warehouse(spark, d))["fact_sales"]
    return fact.withColumns(
        {"sales_amount": F.col("sales_amount").cast("double") / 10000, "store_key": F.col("store_key").cast("int")}
    )


def _money(df, name="revenue"):
    return df.withColumn(name, units_to_money(F.col(name)))


# Reports through the plans on the rental database


def _tables(spark, d, *names):
    tables = roles.rental_tables(spark, d)
    return [tables[n] for n in names]


@query(f"""
select p_name as title, {money(f'sum({AMOUNT})')} as revenue from lineitem join part on l_partkey = p_partkey group by 1""")
def revenue_by_title(spark, d):
    return _money(rental.revenue_by_title(*_tables(spark, d, "payment", "rental", "inventory", "film")))


@query(f"""
select p_brand as category, {money(f'sum({AMOUNT})')} as total_sales
from lineitem join part on l_partkey = p_partkey group by 1""")
def sales_by_film_category(spark, d):
    sales = rental.sales_by_film_category(*_tables(spark, d, "payment", "rental", "inventory", "film_category", "category"))
    return _money(sales, "total_sales")


@query(f"""
select n_name || ',' || r_name as store, replace(s_name, '#', ' ') as manager, {money(f'sum({AMOUNT})')} as total_sales
from lineitem join part on l_partkey = p_partkey join supplier on s_suppkey = p_size % 2
join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2""")
def sales_by_film_store(spark, d):
    """Sales per store of the film's copy, with place and manager."""
    names = ["payment", "rental", "inventory", "store", "address", "city", "country", "staff"]
    return _money(rental.sales_by_store(*_tables(spark, d, *names)), "total_sales")


@query(f"""
select n_name as city, {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey group by 1""")
def revenue_by_city(spark, d):
    return _money(rental.revenue_by_city(*_tables(spark, d, "payment", "customer", "address", "city")))


@query(f"""
select p_name as title, n_name as city, cast(month(o_orderdate) as integer) as month, {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2, 3""")
def revenue_by_title_city_month(spark, d):
    names = ["payment", "rental", "inventory", "film", "customer", "address", "city"]
    return _money(rental.revenue_by_title_city_month(*_tables(spark, d, *names)))


@query("select n_name as district, count(*) as n from nation group by 1 order by n desc, district limit 10")
def districts_with_most_addresses(spark, d):
    return rental.top_districts(roles.address(spark, d))


@query("""
select l_partkey as inventory_id from lineitem join part on l_partkey = p_partkey
where p_partkey = 3 and p_size % 2 in (0, 1) group by 1 having count(*) filter (where l_linestatus = 'O') > 0""")
def copies_of_a_film_out(spark, d):
    """Copies of one film that are out, over both stores."""
    stock, rented = roles.inventory(spark, d), roles.stock_rental(spark, d)
    out = [rental.film_in_stock(stock, rented, 3, store, available=False) for store in (0, 1)]
    return out[0].unionByName(out[1])
