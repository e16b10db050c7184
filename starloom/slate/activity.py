"""Questions on the event log; event types stand for pages (view = play, signup = home, error = downgrade)."""

from pyspark.sql import functions as F

from starloom.functions import dates, sql
from starloom.operators.aggregate import average_group_count, group_count, summary_statistics
from starloom.operators.clean import distinct_rows, drop_missing, first_per_key
from starloom.operators.periods import flag_phase, period_average, period_counts
from starloom.plans import activity
from starloom.plans.music import time_table
from starloom.session import read_table
from starloom.slate import query


def _events(spark, d):
    return read_table(spark, d, "events")


def _log(spark, d):
    """Events with the column names of the user log; small values stand for logged-out users (blank id)."""
    return _events(spark, d).select(
        "event_id",
        F.when(F.col("value") < 5, "").otherwise(F.col("user_id").cast("string")).alias("userId"),
        F.when(F.col("event_type") != "click", F.dayofmonth("ts")).alias("sessionId"),
        "ts",
        F.col("event_type").alias("page"),
        "value",
    )


@query("""
select cast(hour(ts) as integer) as hour, count(*) as count from events where event_type = 'view' group by 1""")
def events_per_hour(spark, d):
    return activity.plays_by_hour(_events(spark, d), page="event_type", play="view")


@query("""
select distinct event_type from events
except select event_type from events where user_id = 7 and cast(ts as date) = date '2024-01-05'""")
def pages_not_visited(spark, d):
    log = _events(spark, d)
    who = (F.col("user_id") == 7) & (F.to_date("ts") == F.lit("2024-01-05").cast("date"))
    return activity.pages_not_visited(log, who, "event_type")


@query("select count(distinct user_id) as users from events where event_type = 'error' and value > 20")
def distinct_users(spark, d):
    who = (F.col("event_type") == "error") & (F.col("value") > 20)
    return activity.distinct_users(_events(spark, d), who, "user_id")


@query("""
select user_id, count(user_id) as plays from events group by 1 order by plays desc, user_id limit 1""")
def top_event_user(spark, d):
    return activity.most_played(_events(spark, d), "user_id")


@query("""
with c as (select user_id, count(user_id) as plays from events group by 1)
select user_id, plays from c where plays = (select max(plays) from c)""")
def top_user_with_ties(spark, d):
    return activity.most_played(_events(spark, d), "user_id", ties=True)


@query("""
select event_id, user_id, cast(sum(case when event_type = 'error' then 1 else 0 end) over (
         partition by user_id order by ts desc range between unbounded preceding and current row) as bigint) as phase
from events""")
def event_phase_range(spark, d):
    """Downgrades at or after each event."""
    phased = flag_phase(_events(spark, d), "user_id", "ts", F.col("event_type") == "error", "range")
    return phased.select("event_id", "user_id", "phase")


@query("""
select event_id, user_id, cast(sum(case when event_type = 'signup' then 1 else 0 end) over (
         partition by user_id order by ts desc, event_id rows between unbounded preceding and current row) as bigint) as period
from events where event_type in ('view', 'signup')""")
def event_period_rows(spark, d):
    """Period between home visits of each play and home visit."""
    kept = _events(spark, d).where(F.col("event_type").isin("view", "signup"))
    flag = F.col("event_type") == "signup"
    phased = flag_phase(kept, "user_id", "ts", flag, "rows", ["event_id"], name="period")
    return phased.select("event_id", "user_id", "period")


_PERIODS = """
with p as (
  select user_id, event_type, sum(case when event_type = 'signup' then 1 else 0 end) over (
           partition by user_id order by ts desc range between unbounded preceding and current row) as period
  from events where event_type in ('view', 'signup')),
m as (select user_id, max(period) as last from p group by 1),
c as (select p.user_id, period, last, count(*) as items from p join m on p.user_id = m.user_id
      where event_type = 'view' group by 1, 2, 3)
"""


def _is(page):
    return F.col("event_type") == page


@query(_PERIODS + "select round(avg(items), 6) as average from c")
def avg_views_between_signups(spark, d):
    average = period_average(_events(spark, d), "user_id", "ts", _is("view"), _is("signup"))
    return average.select(F.round("average", 6).alias("average"))


@query(_PERIODS + "select user_id, cast(period as bigint) as period, items from c where period > 0 and period < last")
def views_in_closed_periods(spark, d):
    """Plays in each period that both begins and ends with a home visit."""
    return period_counts(_events(spark, d), "user_id", "ts", _is("view"), _is("signup"), closed_only=True)


@query("select round(avg(n), 6) as average from (select count(*) as n from events group by user_id, event_type)")
def average_events_per_page(spark, d):
    """Average of group counts."""
    average = average_group_count(_events(spark, d), ["user_id", "event_type"])
    return average.select(F.round("average", 6).alias("average"))


@query("""
select event_type as page, count(*) as count from events
where value >= 5 and event_type <> 'click' group by 1""")
def valid_page_counts(spark, d):
    """Rows per page without missing sessions and blank users."""
    return group_count(activity.valid_rows(_log(spark, d)), "page")


@query("""
select case when value < 5 then '' else cast(user_id as varchar) end as "userId", event_type as page
from events group by 1, 2""")
def distinct_user_pages(spark, d):
    return distinct_rows(_log(spark, d), "userId", "page")


@query("select count(*) as count from events where event_type = 'purchase'")
def count_one_item(spark, d):
    return _events(spark, d).where("event_type = 'purchase'").agg(F.count("*").alias("count"))


@query("""
select event_id, ts, user_id from events
where (event_type = 'purchase' and value > 100) or (event_type = 'view' and value between 5 and 6)""")
def filtered_events(spark, d):
    """AND / OR predicates that reach the scan."""
    page, value = F.col("event_type"), F.col("value")
    kept = ((page == "purchase") & (value > 100)) | ((page == "view") & value.between(5, 6))
    return _events(spark, d).where(kept).select("event_id", "ts", "user_id")


@query("""
select start_time, cast(hour(start_time) as integer) as hour, cast(day(start_time) as integer) as day,
       cast(week(start_time) as integer) as week, cast(month(start_time) as integer) as month,
       cast(year(start_time) as integer) as year, cast(isodow(start_time) - 1 as integer) as weekday
from (select distinct date_trunc('second', ts) as start_time from events where event_type = 'view')""")
def time_dim_events(spark, d):
    """Time dimension of the plays, epoch milliseconds cut to whole seconds."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    plays = _events(spark, d).where("event_type = 'view'")
    times = time_table(plays.select(dates.from_millis_whole_seconds(millis).alias("start_time")))
    return times.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query("""
select distinct cast(o_orderdate as date) as day, cast(isodow(o_orderdate) - 1 as integer) as mon0,
       cast(dayofweek(o_orderdate) as integer) as sun0, cast(isodow(o_orderdate) as integer) as iso,
       strftime(o_orderdate, '%a') as name, lpad(cast(week(o_orderdate) as varchar), 2, '0') as week_text,
       last_day(o_orderdate) as month_end, isodow(o_orderdate) > 5 as weekend
from orders""")
def weekday_variants(spark, d):
    """The four weekday conventions, ISO week text and month end of every order day."""
    day = F.to_date("o_orderdate")
    days = read_table(spark, d, "orders").select(day.alias("day")).distinct()
    return days.select(
        "day",
        *[dates.weekday("day", c).alias(c) for c in ("mon0", "sun0", "iso", "name")],
        dates.iso_week_text("day").alias("week_text"),
        F.last_day("day").alias("month_end"),
        dates.is_weekend("day").alias("weekend"),
    )


@query("""
select 'l_quantity' as "column", count(l_quantity) as count, avg(l_quantity) as mean,
       round(stddev(l_quantity), 6) as stddev, min(l_quantity) as min, max(l_quantity) as max from lineitem
union all select 'l_linenumber', count(l_linenumber), avg(l_linenumber), round(stddev(l_linenumber), 6),
       min(l_linenumber), max(l_linenumber) from lineitem""")
def describe_lines(spark, d):
    """Summary statistics, all columns in one pass."""
    stats = summary_statistics(read_table(spark, d, "lineitem"), "l_quantity", "l_linenumber")
    return stats.withColumn("stddev", F.round("stddev", 6))


@query("""
with r as (select c_nationkey, c_mktsegment, c_custkey, c_acctbal, row_number() over (
  partition by c_nationkey, c_mktsegment order by c_acctbal desc, c_custkey) as n from customer where c_acctbal > 0)
select c_nationkey, c_mktsegment, c_custkey, c_acctbal from r where n = 1""")
def dedup_city_segment(spark, d):
    """One row per key, chosen by a fixed order."""
    rows = drop_missing(read_table(spark, d, "customer"), required=["c_acctbal"]).where("c_acctbal > 0")
    kept = first_per_key(rows, ["c_nationkey", "c_mktsegment"], [F.desc("c_acctbal"), "c_custkey"])
    return kept.select("c_nationkey", "c_mktsegment", "c_custkey", "c_acctbal")


# The same questions as SQL text over a view


def _view(spark, d):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    sql.register_views(log_table=_events(spark, d).select("user_id", F.col("event_type").alias("page"), millis.alias("ts")))


@query("""
select cast(hour(ts) as integer) as hour, count(*) as count from events where event_type = 'view' group by 1""")
def sql_plays_by_hour(spark, d):
    """SQL text with a registered function; ``==`` is accepted."""
    _view(spark, d)
    sql.register_functions(spark, ["get_hour"])
    return spark.sql("select get_hour(ts) as hour, count(*) as count from log_table where page == 'view' group by hour")


@query("""
select distinct event_type as page from events
except select event_type from events where user_id = 7 and cast(ts as date) = date '2024-01-05'""")
def sql_pages_not_visited(spark, d):
    """A correlated NOT EXISTS, which Spark turns into an anti join; pages in order."""
    _view(spark, d)
    return spark.sql("""
        select distinct shown.page from log_table shown
        where not exists (
          select 1 from log_table seen
          where seen.page = shown.page and seen.user_id = 7 and to_date(timestamp_millis(seen.ts)) = date'2024-01-05')
        order by shown.page""")


@query("""
with c as (select user_id, count(user_id) as plays from events group by 1)
select user_id, plays from c where plays = (select max(plays) from c)""")
def sql_top_user(spark, d):
    """Self-join of the counts with their maximum."""
    _view(spark, d)
    return spark.sql("""
        with counts as (select user_id, count(user_id) as plays from log_table group by user_id)
        select counts.user_id, counts.plays
        from (select max(plays) as most from counts) as best join counts on best.most = counts.plays""")


@query("select event_type as page, count(*) filter (where event_type = 'error') as flagged from events group by 1")
def udf_page_flags(spark, d):
    """A typed Python function on Arrow batches."""
    flagged = _events(spark, d).select(F.col("event_type").alias("page"), sql.page_flag("error")("event_type").alias("flag"))
    return flagged.groupBy("page").agg(F.sum("flag").alias("flagged"))
