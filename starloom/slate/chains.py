"""Sources by run date, inferred and block formats, and whole loads from files to answers."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.functions import sql
from starloom.operators.writes import create_table, load_table, read_loaded, write_csv
from starloom.plans import music, payments
from starloom.session import read_table, work_folder
from starloom.slate import query
from starloom.slate import music as music_tables
from starloom.slate.roles import AMOUNT, lines, money
from starloom.sources import files, labels


@query("select event_id, event_type, value from events")
def scan_json_inferred(spark, d):
    """JSON lines whose columns and types Spark finds out."""
    path = work_folder(spark, "inferred")
    read_table(spark, d, "events").select("event_id", "event_type", "value").write.json(path)
    return files.scan_json(spark, path).select("event_id", "event_type", "value")


@query("""
select o_orderkey, cast(o_totalprice as double) as o_totalprice from orders
where o_orderdate >= date '1997-05-01' and o_orderdate < date '1997-06-01'""")
def run_date_path(spark, d):
    """The files of one month, by a path template and a run date."""
    root = work_folder(spark, "by-month")
    orders = read_table(spark, d, "orders").where("year(o_orderdate) = 1997")
    for month in (4, 5, 6):
        kept = orders.where(F.month("o_orderdate") == month).select("o_orderkey", "o_totalprice")
        write_csv(kept, files.month_path(root + "/{year}/{month}", dt.date(1997, month, 1)))
    path = files.month_path(root + "/{year}/{month}", dt.date(1997, 5, 20))
    return files.stage_csv(spark, path, "o_orderkey long, o_totalprice double")


@query("""
select o_orderkey, o_custkey from orders where o_orderdate >= date '1996-11-01' and o_orderdate < date '1996-12-01'""")
def run_date_slice(spark, d):
    """The month of a run date from a table in folders by year and month: other folders are not read."""
    path = work_folder(spark, "by-month")
    dated = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    dated.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(path)
    return files.month_slice(files.scan_parquet(spark, path), dt.date(1996, 11, 7)).select("o_orderkey", "o_custkey")


@query("""
select 'i94nation' as block, cast(n_nationkey as varchar) as code, n_name as label from nation
union all select 'i94region', r_name, 'Region ' || r_regionkey from region""")
def label_blocks(spark, d):
    """Named blocks of value labels in a lookup file."""
    path = work_folder(spark, "labels")
    heads = spark.createDataFrame([(0, -1, "value i94nation"), (1, -1, "  value $i94region")], "block int, line long, value string")
    nation = read_table(spark, d, "nation").select(
        F.lit(0).alias("block"), F.col("n_nationkey").alias("line"), F.format_string("   %d =  '%s'", "n_nationkey", "n_name").alias("value")
    )
    region = read_table(spark, d, "region").select(
        F.lit(1).alias("block"), F.col("r_regionkey").alias("line"), F.format_string("\t'%s' = 'Region %d'", "r_name", "r_regionkey").alias("value")
    )
    whole = heads.unionByName(nation).unionByName(region).coalesce(1).sortWithinPartitions("block", "line")
    whole.select("value").write.text(path)
    return labels.parse_label_blocks(files.scan_lines(spark, path)).select("block", "code", "label")


@query("""
select column_index as position, column_name, case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
         when 'VARCHAR' then 'string' when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp_ntz' else lower(data_type) end as data_type
from duckdb_columns() where table_name = 'orders'""")
def describe_orders(spark, d):
    """Names and types of a table's columns, in order."""
    return files.describe_table(read_table(spark, d, "orders")).select("position", "column_name", "data_type")


@query("""
select n_name as nation, count(*) as customers from customer join nation on c_nationkey = n_nationkey
where n_name in ('NATION_1', 'NATION_7') group by 1""")
def literal_rows_lookup(spark, d):
    """Rows given in the program, joined to a table."""
    wanted = files.literal_rows(spark, [("NATION_1",), ("NATION_7",)], "nation string")
    nation = read_table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("nation")).join(wanted, "nation")
    people = read_table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    return people.join(nation, "n_nationkey").select("nation", "customers")


@query("""
select cast(user_id as varchar) as user_id, event_type as level, count(*) as records from events group by 1, 2""")
def created_table(spark, d):
    """A table of the data model created empty, loaded in two parts; creating it again changes nothing."""
    root = work_folder(spark, "model")
    rows = read_table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("first_name", "last_name", "gender")],
        F.col("event_type").alias("level"),
    )
    path = create_table(spark, root, "users")
    half = F.pmod(F.xxhash64("user_id"), F.lit(2)) == 0
    load_table(rows.where(half), path, "append")
    create_table(spark, root, "users")
    load_table(rows.where(~half), path, "append")
    return read_loaded(spark, path).groupBy("user_id", "level").agg(F.count("*").alias("records"))


@query(f"""
select cast(month(l_shipdate) as integer) as month, {money(f'sum({AMOUNT})')} as revenue from lineitem group by 1""")
def payment_csv_untyped(spark, d):
    """Payment files read as text and cast."""
    path = work_folder(spark, "payments")
    paid = lines(spark, d, F.col("l_shipdate").alias("payment_date"))
    money_ = (F.col("amount") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(18,4)")
    write_csv(paid.select("payment_date", money_.alias("amount")), path, sep=";")
    read = payments.read_payments_untyped(spark, path).withColumn("amount", F.col("amount").cast("decimal(18,4)"))
    total = read.groupBy(F.month("payment_date").alias("month")).agg(F.sum("amount").alias("revenue"))
    return total.withColumn("revenue", F.round("revenue", 2).cast("double"))


# Relational star of the music log, file by file


@query(f"""{music_tables._LOG}, lot as (
  select log.*, event_id, arg_max(level, (start_time, event_id)) over (partition by user_id) as last_level,
         arg_min(struct_pack(f := first_name, l := last_name, g := gender), (start_time, event_id)) over (partition by user_id) as who
  from log)
select distinct user_id, who.f as first_name, who.l as last_name, who.g as gender, last_level as level from lot""")
def relational_star_users(spark, d):
    """Users after two lots of files: the level is the last seen, the rest the first seen."""
    return read_loaded(spark, f"{_relational_star(spark, d)}/users")


@query(f"""{music_tables._LOG} select {music_tables._COLUMNS.format(start='start_time')}
from log left join song on song = title and artist = artist_name and length = duration""")
def relational_star_plays(spark, d):
    """Plays of both lots as stored; those without a song stay."""
    plays = read_loaded(spark, f"{_relational_star(spark, d)}/songplays")
    return plays.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


def _relational_star(spark, d):
    """Song files, then log files in two lots, into the five tables of the relational variant."""
    root = work_folder(spark, "relational")
    song_files, log_files = f"{root}/song_files", f"{root}/log_files"
    music_tables.songs(spark, d).write.json(song_files)
    songs = files.scan_json(spark, song_files, music_tables.songs(spark, d).schema)
    for name in ("users", "songs", "artists", "time", "songplays"):
        create_table(spark, root, name)
    load_table(music.songs_first(songs, read_loaded(spark, f"{root}/songs"), ["song_id"]), f"{root}/songs")
    load_table(music.artists_first(songs), f"{root}/artists")
    log = music_tables.log(spark, d)
    early = F.col("ts") < 1705363200000
    for number, lot in enumerate((log.where(early), log.where(~early))):
        path = f"{log_files}/{number}"
        lot.write.json(path)
        staged = files.scan_json(spark, path, log.schema)
        load_table(music.users_current(staged, read_loaded(spark, f"{root}/users")), f"{root}/users")
        plays = music.songplays(staged, songs, "relational")
        load_table(plays, f"{root}/songplays", "append")
        known = read_loaded(spark, f"{root}/time").select("start_time")
        starts = plays.select("start_time").join(known, "start_time", "left_anti")
        load_table(music.time_table(starts), f"{root}/time", "append")
    return root


# The benchmark's queries as SQL with comma joins


@query(f"""
select cast(year(o_orderdate) as integer) as year, p_brand as brand, {money(f'sum({AMOUNT})')} as revenue
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey where p_type = 'PROMO' and n_regionkey = 2 group by 1, 2""")
def comma_join_two_dimensions(spark, d):
    """Revenue by year and brand; the join conditions stand in WHERE."""
    _benchmark_views(spark, d)
    return spark.sql("""
        select year(o_orderdate) as year, p_brand as brand, cast(round(sum(amount) * 0.0001bd, 2) as double) as revenue
        from star_lines, star_orders, star_part, star_supplier, star_nation
        where l_orderkey = o_orderkey and l_partkey = p_partkey and l_suppkey = s_suppkey and s_nationkey = n_nationkey
          and p_type = 'PROMO' and n_regionkey = 2
        group by year(o_orderdate), p_brand order by year, brand""")


@query(f"""
select {money(f'sum({AMOUNT})')} as revenue from lineitem join orders on l_orderkey = o_orderkey
where year(o_orderdate) = 1997 and l_discount between 0.01 and 0.03 and l_quantity < 24""")
def comma_join_one_dimension(spark, d):
    _benchmark_views(spark, d)
    return spark.sql("""
        select cast(round(sum(amount) * 0.0001bd, 2) as double) as revenue from star_lines, star_orders
        where l_orderkey = o_orderkey and year(o_orderdate) = 1997 and l_discount between 0.01 and 0.03 and l_quantity < 24""")


def _benchmark_views(spark, d):
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_discount", "l_quantity")
    sql.register_views(
        star_lines=lines(spark, d, *keys),
        **{f"star_{name}": read_table(spark, d, table) for name, table in (("orders", "orders"), ("part", "part"), ("supplier", "supplier"), ("nation", "nation"))},
    )
