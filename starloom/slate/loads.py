"""Keyed loads, query tables, file formats and scheduled loads."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions.money import cents_to_money, hundredths
from starloom.operators import keyed_state, snapshots
from starloom.operators import upsert as keyed
from starloom.operators.query_table import lookup
from starloom.operators.writes import (
    denormalise,
    load_table,
    normalise,
    normalise_values,
    write_csv,
    write_partitioned,
)
from starloom.plans import payments, query_tables
from starloom.session import read_table, work_folder
from starloom.slate import query
from starloom.sources import files
from starloom.streaming.incremental import backfill, load_partition
from starloom.streaming.ingest import upsert_stream

_HALF = "2024-01-16"
_ORDER = ["ts", "event_id"]


def _halves(spark, d):
    events = read_table(spark, d, "events")
    half = F.lit(_HALF).cast("timestamp_ntz")
    return events.where(F.col("ts") < half), events.where(F.col("ts") >= half)


def _known_users(events):
    """One row per user: type of the first and value of the last event."""
    place = F.struct(*_ORDER)
    return events.groupBy("user_id").agg(
        F.min_by("event_type", place).alias("event_type"), F.max_by("value", place).alias("value")
    )


_USERS = """
select user_id, arg_min(event_type, (ts, event_id)) as event_type, arg_max(value, (ts, event_id)) as value
from events group by user_id"""


@query(_USERS)
def users_upsert(spark, d):
    """The second half of the events folded into the users of the first: only ``value`` is updated."""
    old, new = _halves(spark, d)
    return keyed.upsert(_known_users(old), new, ["user_id"], ["value"], _ORDER)


@query("""
select event_type, user_id, event_id from (
  select *, row_number() over (partition by event_type, user_id order by ts, event_id) as n from events) where n = 1""")
def insert_ignore(spark, d):
    """The first row of each key stays; later ones are ignored."""
    old, new = _halves(spark, d)
    keys = ["event_type", "user_id"]
    empty = old.limit(0).select(*keys, "event_id", "ts")
    known = keyed.insert_ignore(empty, old, keys, _ORDER)
    return keyed.insert_ignore(known, new, keys, _ORDER).select(*keys, "event_id")


@query("""
select user_id, event_type, event_id, value from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from events)
where n = 1""")
def last_write_wins(spark, d):
    kept = keyed.last_write(read_table(spark, d, "events"), ["user_id", "event_type"], _ORDER)
    return kept.select("user_id", "event_type", "event_id", "value")


@query("""
select conv_id, turn, role, text from (
  select *, row_number() over (partition by conv_id, turn order by role desc, text desc) as n from conversations)
where n = 1""")
def session_item_table(spark, d):
    """Sessions in item order, one row per key."""
    talk = read_table(spark, d, "conversations")
    return keyed.build_query_table(talk, ["conv_id"], ["turn"], ["role", "text"], ["role", "text"])


@query("""
select event_type, user_id, value from (
  select *, row_number() over (partition by event_type, user_id order by ts desc, event_id desc) as n from events)
where n = 1 and event_type = 'view'""")
def song_users_lookup(spark, d):
    """Users who heard a song: a table keyed by song and user, read for one song."""
    table = keyed.build_query_table(read_table(spark, d, "events"), ["event_type"], ["user_id"], ["value"], _ORDER)
    return lookup(table, event_type="view")


@query(r"""
select conv_id, turn, role, cast(i - 1 as integer) as position, lines[i] as line
from (select conv_id, turn, role, string_split(text, chr(10)) as lines from conversations),
     unnest(range(1, len(lines) + 1)) as r(i)""")
def normalise_lists(spark, d):
    """Rows with a list split into a parent table and one row per item, then joined again."""
    talk = read_table(spark, d, "conversations").withColumn("key", F.struct("conv_id", "turn"))
    listed = talk.withColumn("lines", F.split("text", "\n"))
    parents, children = normalise(listed, "key", "lines", "line", ["role"])
    return denormalise(parents, children, "key").select("key.conv_id", "key.turn", "role", "position", "line")


@query("""
select p_brand, count(*) as parts, cast(sum(cast(p_retailprice as decimal(12,2))) as double) as price from part group by 1""")
def normalise_brands(spark, d):
    """Brands moved to a keyed table, then joined again by key."""
    part = read_table(spark, d, "part").select("p_partkey", "p_brand", hundredths("p_retailprice").cast("decimal(18,0)").alias("cents"))
    brands, keyed_parts = normalise_values(part, "p_brand", "brand_id")
    per_key = keyed_parts.groupBy("brand_id").agg(F.count("*").alias("parts"), cents_to_money(F.sum("cents")).alias("price"))
    return denormalise(brands, per_key, "brand_id").select("p_brand", "parts", "price")


@query("""
select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month, count(*) as orders
from orders where o_orderdate >= date '1996-01-01' and o_orderdate < date '1999-01-01' group by 1, 2""")
def month_partition_load(spark, d):
    """Months backfilled into a partitioned table; one month is loaded again and stays single."""
    path = work_folder(spark, "orders-by-month")
    source = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    backfill(source, path, "o_orderdate", "1996-01-15", "1998-12-01")
    load_partition(source, path, "o_orderdate", "1997-05-20")
    return files.scan_parquet(spark, path).groupBy("year", "month").agg(F.count("*").alias("orders"))


@query("""
select event_id, user_id, value from events where month(ts) = 1 and day(ts) = 17""")
def partition_slice(spark, d):
    """Leaf glob of a partitioned table, with the partition columns kept."""
    path = work_folder(spark, "events-by-day")
    dated = read_table(spark, d, "events").withColumns({"month": F.month("ts"), "day": F.dayofmonth("ts")})
    write_partitioned(dated, path, "month", "day")
    part = files.scan_parquet(spark, f"{path}/month=*/day=17", base_path=path)
    return part.where("month = 1").select("event_id", "user_id", "value")


@query("""
select n_nationkey, n_name, count(*) as suppliers from nation join supplier on n_nationkey = s_nationkey group by 1, 2
union all select 1000, 'total', count(*) from supplier""")
def append_load(spark, d):
    """A table replaced, then added to."""
    path = work_folder(spark, "append")
    supplier = read_table(spark, d, "supplier")
    per_nation = (
        supplier.groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.count("*").alias("suppliers"))
        .join(read_table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey")
        .select("n_nationkey", "n_name", "suppliers")
    )
    load_table(per_nation, path)
    load_table(per_nation, path)
    total = supplier.agg(F.count("*").alias("suppliers"))
    named = total.select(F.lit(1000).alias("n_nationkey"), F.lit("total").alias("n_name"), "suppliers")
    return load_table(named, path, "append")


@query(_USERS)
def versioned_users(spark, d):
    """The upsert stored as published states of a keyed table; a batch rewrites the buckets it touches."""
    root = work_folder(spark, "users")
    empty = spark.createDataFrame([], "user_id long, event_type string, value double")
    merge = lambda rows, new: keyed.upsert(rows, new, ["user_id"], ["value"], _ORDER)
    for number, lot in enumerate(_halves(spark, d)):
        keyed_state.fold(root, number, lot, empty, ["user_id"], merge)
    return snapshots.read_state(spark, root)


@query("""
select user_id, arg_max(value, (ts, event_id)) as value from events where user_id = 7 group by user_id""")
def user_state_lookup(spark, d):
    """One user of a keyed table: only the bucket of the key is read."""
    root = work_folder(spark, "users")
    empty = spark.createDataFrame([], "user_id long, value double")
    merge = lambda rows, new: keyed.upsert(rows, new, ["user_id"], ["value"], _ORDER)
    keyed_state.fold(root, 0, read_table(spark, d, "events"), empty, ["user_id"], merge)
    return keyed_state.read_key(spark, root, user_id=7)


@query(_USERS)
def stream_user_upsert(spark, d):
    """Event files that arrive in two lots, each folded into the user table by one run of the stream."""
    incoming, root, checkpoint = (work_folder(spark, name) for name in ("incoming", "state", "progress"))
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    names = ["event_id", "ts", "user_id", "event_type", "value"]
    empty = spark.createDataFrame([], "user_id long, event_type string, value double")
    for lot in _halves(spark, d):
        lot.select(*names).write.mode("append").json(incoming)
        source = spark.readStream.schema(schema).json(incoming)
        upsert_stream(source, empty, root, checkpoint, ["user_id"], ["value"], _ORDER).awaitTermination()
    return snapshots.read_state(spark, root)


@query("""
select event_id, date_trunc('millisecond', ts) as start_time, user_id, cast(json_extract(props, '$.k') as integer) as k
from events""")
def stage_json_paths(spark, d):
    """JSON loaded through a path mapping, epoch milliseconds to time."""
    path = work_folder(spark, "events-json")
    read_table(spark, d, "events").select(
        F.col("event_id").alias("id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.struct("user_id", F.from_json("props", "k int").alias("props")).alias("who"),
    ).write.json(path)
    mapping = [
        ("id", "event_id", "long"),
        ("ts", "start_time", "timestamp"),
        ("who.user_id", "user_id", "long"),
        ("who.props.k", "k", "int"),
    ]
    staged = files.stage_json(spark, path, mapping, time_columns=["start_time"], recursive=True, pattern="*.json")
    return staged.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query("select l_orderkey, l_partkey, l_quantity, l_shipdate from lineitem")
def stage_gzip_csv(spark, d):
    """Compressed ``;`` files with a header, read with a schema and spread over tasks."""
    path = work_folder(spark, "lines-csv")
    kept = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    write_csv(kept, path, sep=";", quote_all=True, compression="gzip")
    schema = "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp_ntz"
    return files.stage_csv(spark, path, schema, sep=";", partitions=spark.sparkContext.defaultParallelism)


@query("""
select cast(month(l_shipdate) as integer) as month, cast(sum(cast(l_extendedprice as decimal(12,2))) as double) as revenue
from lineitem group by 1""")
def payment_csv_revenue(spark, d):
    """Payment files to monthly revenue."""
    path = work_folder(spark, "payments")
    paid = read_table(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("payment_id"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_linenumber").alias("staff_id"),
        F.col("l_linenumber").alias("rental_id"),
        F.col("l_extendedprice").alias("amount"),
        F.to_date("l_shipdate").alias("payment_date"),
    )
    write_csv(paid, path, sep=";")
    revenue = payments.monthly_revenue(payments.read_payments(spark, path))
    return revenue.withColumn("revenue", F.col("revenue").cast("double"))


@query("select event_type as value, count(*) as count from events group by 1")
def text_line_counts(spark, d):
    """Text files, one value per line, counted."""
    path = work_folder(spark, "text")
    read_table(spark, d, "events").select("event_type").write.text(path)
    return files.scan_text(spark, path).groupBy("value").agg(F.count("*").alias("count"))


@query("""
select cast(user_id * 100 + day(ts) as integer) as "sessionId", cast(event_id % 500 as integer) as "itemInSession",
       arg_max('Artist ' || event_type, event_id) as artist, arg_max('Song ' || user_id, event_id) as song
from events where event_type <> 'error' group by 1, 2""")
def event_history_table(spark, d):
    """Daily event files to one quoted file set, then to a table keyed by session and item; the last row of a key wins."""
    folder = work_folder(spark, "history")
    text = F.lit("x")
    daily = read_table(spark, d, "events").select(
        F.when(F.col("event_type") != "error", F.concat(F.lit("Artist "), "event_type")).alias("artist"),
        text.alias("firstName"),
        text.alias("gender"),
        (F.col("event_id") % 500).alias("itemInSession"),
        text.alias("lastName"),
        F.col("event_id").alias("length"),
        text.alias("level"),
        text.alias("location"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("sessionId"),
        F.concat(F.lit("Song "), F.col("user_id").cast("string")).alias("song"),
        F.col("user_id").alias("userId"),
    )
    write_csv(daily, f"{folder}/daily")
    query_tables.write_history(query_tables.event_history(spark, f"{folder}/daily"), f"{folder}/all")
    events = query_tables.event_history(spark, f"{folder}/all")
    table = keyed.build_query_table(events, *query_tables.SESSION_ITEMS, ["length"])
    return table.select("sessionId", "itemInSession", "artist", "song")


@query("select cast(day(ts) as integer) as day, count(*) as records from events group by 1")
def rows_per_day_folder(spark, d):
    """Nested folders of JSON files walked at once, rows counted per file and folder."""
    path = work_folder(spark, "walk")
    dated = read_table(spark, d, "events").select("event_id", F.dayofmonth("ts").alias("day"))
    dated.hint("rebalance", "day").write.partitionBy("day").json(path)
    scanned = files.scan_json(spark, path, "event_id long", recursive=True, pattern="*.json")
    folder = F.regexp_extract("file", r"day=(\d+)/", 1).cast("int").alias("day")
    return files.rows_per_file(scanned).groupBy(folder).agg(F.sum("records").alias("records"))


@query("select event_id, user_id, event_type from events")
def stage_json_any_case(spark, d):
    """JSON whose keys are written in another case than the table's columns."""
    path = work_folder(spark, "any-case")
    read_table(spark, d, "events").select(
        F.col("event_id").alias("Event_ID"), F.col("user_id").alias("USER_ID"), "event_type", "value"
    ).write.json(path)
    return files.scan_json_any_case(spark, path, StructType.fromDDL("event_id long, user_id long, event_type string"))
