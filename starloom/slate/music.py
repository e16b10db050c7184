"""The music star, with a log made from the events and songs made from the parts."""

from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.aggregate import table_counts
from starloom.operators.writes import load_table
from starloom.plans import music
from starloom.session import read_table, work_folder
from starloom.slate import query

_K = "cast(json_extract(props, '$.k') as integer)"


def log(spark, d):
    """Event log: a view is a song play; the number in ``props`` names the song and artist.

    Every second play is 0.3 seconds longer than its song.
    """
    k = F.from_json("props", "k int")["k"]
    return read_table(spark, d, "events").select(
        F.concat(F.lit("Artist "), (k % 25).cast("string")).alias("artist"),
        F.concat(F.lit("First"), (F.col("user_id") % 13).cast("string")).alias("firstName"),
        F.concat(F.lit("Last"), (F.col("user_id") % 17).cast("string")).alias("lastName"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.col("event_id") % 50).cast("int").alias("itemInSession"),
        (F.floor(k / 2) * 10 + F.when(F.col("event_id") % 2 == 1, 0.3).otherwise(0.0)).alias("length"),
        F.when(F.col("value") > 30, "paid").otherwise("free").alias("level"),
        F.concat(F.lit("City "), (F.col("user_id") % 25).cast("string")).alias("location"),
        F.when(F.col("event_type") == "view", "NextSong").otherwise(F.col("event_type")).alias("page"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).cast("int").alias("sessionId"),
        F.concat(F.lit("Song "), F.floor(k / 2).cast("string")).alias("song"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.lit("agent").alias("userAgent"),
        F.col("user_id").cast("string").alias("userId"),
    )


def songs(spark, d):
    """A song for every size and brand of part; each title occurs under many artists."""
    brand = F.element_at(F.split("p_brand", "#"), 2).cast("int")
    return (
        read_table(spark, d, "part")
        .select("p_size", brand.alias("brand"))
        .distinct()
        .select(
            F.format_string("S%d-%d", "p_size", "brand").alias("song_id"),
            F.concat(F.lit("Song "), F.col("p_size").cast("string")).alias("title"),
            F.concat(F.lit("A"), F.col("brand").cast("string")).alias("artist_id"),
            F.concat(F.lit("Artist "), F.col("brand").cast("string")).alias("artist_name"),
            F.when(F.col("brand") % 3 != 0, F.concat(F.lit("City "), F.col("brand").cast("string"))).alias("artist_location"),
            (F.col("brand") + 0.5).alias("artist_latitude"),
            (-F.col("brand") - 0.25).alias("artist_longitude"),
            (F.col("p_size") * 10.0).alias("duration"),
            F.lit(1).alias("num_songs"),
            (F.lit(1990) + F.col("p_size") % 30).alias("year"),
        )
    )


# SQL of the same log and songs.
_LOG = f"""
with log as (
  select 'Artist ' || ({_K} % 25) as artist, 'First' || (user_id % 13) as first_name, 'Last' || (user_id % 17) as last_name,
         case when user_id % 2 = 0 then 'F' else 'M' end as gender, event_id,
         ({_K} // 2) * 10 + case when event_id % 2 = 1 then 0.3 else 0 end as length,
         case when value > 30 then 'paid' else 'free' end as level, 'City ' || (user_id % 25) as location,
         cast(user_id * 100 + day(ts) as integer) as session_id, 'Song ' || ({_K} // 2) as song,
         date_trunc('millisecond', ts) as start_time, cast(user_id as varchar) as user_id
  from events where event_type = 'view'),
song as (
  select distinct 'S' || p_size || '-' || split_part(p_brand, '#', 2) as song_id, 'Song ' || p_size as title,
         'A' || split_part(p_brand, '#', 2) as artist_id, 'Artist ' || split_part(p_brand, '#', 2) as artist_name,
         p_size * 10.0 as duration, cast(1990 + p_size % 30 as integer) as year,
         cast(split_part(p_brand, '#', 2) as integer) as brand
  from part)
"""
_COLUMNS = """
md5(session_id || cast({start} as varchar)) as songplay_id, {start} as start_time, user_id, level, song_id, artist_id,
session_id, location, 'agent' as user_agent"""


def _plays(spark, d, variant):
    plays = music.songplays(log(spark, d), songs(spark, d), variant)
    return plays.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query(f"""{_LOG} select {_COLUMNS.format(start='start_time')}
from log left join song on song = title and artist = artist_name and length = duration""")
def songplays_relational(spark, d):
    """Left join on title, artist and exact duration."""
    return _plays(spark, d, "relational")


@query(f"""{_LOG} select distinct {_COLUMNS.format(start='start_time')}
from log join song on song = title and artist = artist_name""")
def songplays_warehouse(spark, d):
    """Inner join on title and artist, distinct plays."""
    return _plays(spark, d, "warehouse")


@query(f"""{_LOG} select {_COLUMNS.format(start='start_time')}
from log join song on song = title and artist = artist_name""")
def songplays_lake(spark, d):
    return _plays(spark, d, "lake")


@query(f"""{_LOG} select {_COLUMNS.format(start="date_trunc('second', start_time)")}
from log left join song on song = title and artist = artist_name
     and round(cast(length as decimal(18,3)), 0) = round(cast(duration as decimal(18,3)), 0)""")
def songplays_scheduled(spark, d):
    """Left join with durations rounded to whole seconds; times cut to whole seconds."""
    return _plays(spark, d, "scheduled")


@query(f"{_LOG} select distinct user_id, first_name, last_name, gender, level from log")
def users_distinct(spark, d):
    return music.users(log(spark, d))


@query(f"""{_LOG} select user_id, any_value(first_name) as first_name, any_value(last_name) as last_name,
any_value(gender) as gender, arg_max(level, start_time) as level from log group by user_id""")
def users_current(spark, d):
    """Users with the level last seen, folded into an empty table."""
    known = spark.createDataFrame([], "user_id string, first_name string, last_name string, gender string, level string")
    return music.users_current(log(spark, d), known)


@query(f"{_LOG} select song_id, title, artist_id, year, cast(duration as double) as duration from song")
def songs_table(spark, d):
    return music.songs_table(songs(spark, d))


@query(f"""{_LOG} select distinct artist_id, artist_name as name,
case when brand % 3 <> 0 then 'City ' || brand end as location, cast(brand + 0.5 as double) as latitude,
cast(-brand - 0.25 as double) as longitude from song""")
def artists_table(spark, d):
    return music.artists_first(songs(spark, d))


@query(f"""{_LOG}, t as (select distinct log.start_time from log join song on song = title and artist = artist_name)
select start_time, cast(hour(start_time) as integer) as hour, cast(day(start_time) as integer) as day,
cast(week(start_time) as integer) as week, cast(month(start_time) as integer) as month,
cast(year(start_time) as integer) as year, cast(dayofweek(start_time) as integer) as weekday from t""")
def time_warehouse(spark, d):
    """Time dimension of the matched plays, Sunday = 0."""
    plays = music.songplays(log(spark, d), songs(spark, d), "warehouse")
    return music.time_table(plays, "sun0").withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query(f"""{_LOG}, m as (select * from log join song on song = title and artist = artist_name)
select 'songs' as "table", count(*) as records from song
union all select 'artists', count(distinct artist_id) from song
union all select 'users', count(*) from (select distinct user_id, first_name, last_name, gender, level from log)
union all select 'time', count(distinct start_time) from log
union all select 'songplays', count(*) from m""")
def lake_star_tables(spark, d):
    """The lake variant written as partitioned tables and counted as read back."""
    folder = work_folder(spark, "lake")
    music.write_lake(log(spark, d), songs(spark, d), folder)
    names = ["songs", "artists", "users", "time", "songplays"]
    return table_counts({name: music.lake_table(spark, folder, name) for name in names})


@query(f"""{_LOG} select song_id, title, artist_id, cast(duration as double) as duration, year
from song where artist_id = 'A7'""")
def lake_artist_songs(spark, d):
    """Songs of one artist, from the artist's bucket of the lake."""
    folder = work_folder(spark, "lake")
    music.write_lake(log(spark, d), songs(spark, d), folder, artist_rows=200)
    return music.artist_songs(spark, folder, "A7").select("song_id", "title", "artist_id", "duration", "year")


@query(f"""{_LOG} select {_COLUMNS.format(start='start_time')}, cast(year(start_time) as integer) as year,
cast(month(start_time) as integer) as month from log join song on song = title and artist = artist_name""")
def lake_songplays_rows(spark, d):
    """The fact of the lake as read back, with year and month from the time table."""
    folder = work_folder(spark, "lake")
    music.write_lake(log(spark, d), songs(spark, d), folder)
    plays = music.lake_table(spark, folder, "songplays")
    return plays.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query(f"""{_LOG}, p as (select date_trunc('second', start_time) as start_time, session_id from log)
select 'songplays: has rows' as "check", cast(0 as bigint) as failed, true as passed
union all select 'songplays: start_time not null', 0, true
union all select 'songplays: user_id not null', 0, true
union all select 'time: start_time unique', 0, true
union all select 'songplays: songplay_id unique', n, n = 0
  from (select count(*) as n from (select 1 from p group by session_id, start_time having count(*) > 1))""")
def scheduled_load_checks(spark, d):
    """The scheduled variant loaded into tables, then checked."""
    folder = work_folder(spark, "scheduled")
    plays = load_table(music.songplays(log(spark, d), songs(spark, d), "scheduled"), f"{folder}/songplays")
    times = load_table(music.time_table(plays, "sun0"), f"{folder}/time")
    return quality.all_checks(
        quality.check_rows(plays, "songplays"),
        quality.check_columns(plays, "songplays", quality.not_null("start_time", "user_id")),
        quality.check_unique(times, "time", ["start_time"]),
        quality.check_unique(plays, "songplays", ["songplay_id"]),
    )


@query(f"""{_LOG}
select start_time, cast(hour(start_time) as integer) as hour, cast(day(start_time) as integer) as day,
cast(week(start_time) as integer) as week, cast(month(start_time) as integer) as month,
cast(year(start_time) as integer) as year, strftime(start_time, '%a') as weekday
from (select distinct start_time from log)""")
def time_lake(spark, d):
    """Time dimension of all plays, weekday as text."""
    start = F.timestamp_millis("ts").alias("start_time")
    times = music.time_table(music.song_plays(log(spark, d)).select(start), "name")
    return times.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))
