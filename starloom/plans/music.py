"""Song plays to a star schema, in the four ways the tables are loaded.

========== ============================ ======= ============== ========= ===============
variant    plays match songs on         join    start_time     weekday   user level
========== ============================ ======= ============== ========= ===============
relational title, artist, duration      left    milliseconds   mon0      last seen
warehouse  title, artist                inner   milliseconds   sun0      one row each
lake       title, artist                inner   milliseconds   name      one row each
scheduled  title, artist, whole seconds left    whole seconds  sun0      one row each
========== ============================ ======= ============== ========= ===============
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from starloom.functions import dates, text
from starloom.operators.clean import first_per_key
from starloom.operators.joins import match_plays
from starloom.operators.upsert import insert_ignore, upsert
from starloom.operators.snapshots import newest, publish, read_state, stage


@dataclass(frozen=True)
class Variant:
    on: tuple
    how: str
    weekday: str
    whole_seconds: bool = False
    duration_scale: int | None = None
    one_match: bool = False
    distinct_plays: bool = False


VARIANTS = {
    "relational": Variant(("title", "artist", "duration"), "left", "mon0", one_match=True),
    "warehouse": Variant(("title", "artist"), "inner", "sun0", distinct_plays=True),
    "lake": Variant(("title", "artist"), "inner", "name"),
    "scheduled": Variant(("title", "artist", "duration"), "left", "sun0", whole_seconds=True, duration_scale=0),
}


def song_plays(log: DataFrame) -> DataFrame:
    return log.where("page = 'NextSong'")


def songplays(log: DataFrame, songs: DataFrame, variant: str) -> DataFrame:
    """The fact table. Its key is the MD5 of session and time; see README for ties."""
    v = VARIANTS[variant]
    start = dates.from_millis_whole_seconds("ts") if v.whole_seconds else dates.from_millis("ts")
    plays = song_plays(log).withColumn("start_time", start)
    matched = match_plays(plays, songs, v.how, v.on, v.duration_scale, v.one_match).select(
        text.md5_key("sessionId", "start_time").alias("songplay_id"),
        "start_time",
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
    )
    return matched.distinct() if v.distinct_plays else matched


def users(log: DataFrame) -> DataFrame:
    """Distinct users of the plays; a user seen with two levels has two rows."""
    return (
        song_plays(log)
        .where("userId is not null")
        .select(
            F.col("userId").alias("user_id"),
            F.col("firstName").alias("first_name"),
            F.col("lastName").alias("last_name"),
            "gender",
            "level",
        )
        .distinct()
    )


def users_current(log: DataFrame, known: DataFrame) -> DataFrame:
    """Known users with the new plays folded in: the level is the last seen, the rest the first seen."""
    new = song_plays(log).select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        "ts",
        "itemInSession",
    )
    return upsert(known, new, ["user_id"], ["level"], ["ts", "itemInSession"])


def songs_table(songs: DataFrame) -> DataFrame:
    return songs.where("song_id is not null").select("song_id", "title", "artist_id", "year", "duration").distinct()


def songs_first(songs: DataFrame, known: DataFrame, order_by) -> DataFrame:
    """Known songs plus the first row of each new one."""
    return insert_ignore(known, songs, ["song_id"], order_by)


def artists_table(songs: DataFrame) -> DataFrame:
    return (
        songs.where("artist_id is not null")
        .select(
            "artist_id",
            F.col("artist_name").alias("name"),
            F.col("artist_location").alias("location"),
            F.col("artist_latitude").alias("latitude"),
            F.col("artist_longitude").alias("longitude"),
        )
        .distinct()
    )


def artists_first(songs: DataFrame) -> DataFrame:
    """One row per artist, from the song with the smallest id."""
    return first_per_key(
        songs.where("artist_id is not null").select(
            "song_id",
            "artist_id",
            F.col("artist_name").alias("name"),
            F.col("artist_location").alias("location"),
            F.col("artist_latitude").alias("latitude"),
            F.col("artist_longitude").alias("longitude"),
        ),
        ["artist_id"],
        ["song_id"],
    ).drop("song_id")


def time_table(times: DataFrame, weekday="mon0", start="start_time") -> DataFrame:
    """One row per distinct time."""
    parts = dates.time_parts("start_time", weekday)
    return times.select(F.col(start).alias("start_time")).distinct().withColumns(parts)


def with_time(plays: DataFrame, times: DataFrame) -> DataFrame:
    """Plays with the year and month of their start in the time table."""
    return plays.join(times.select("start_time", "year", "month"), "start_time")


#: Rows of the songs table in a bucket of artists, about.
ARTIST_ROWS = 1_000_000


def artist_bucket(buckets: int, artist="artist_id"):
    return F.pmod(F.xxhash64(artist), F.lit(buckets)).cast("int")


def write_lake(log: DataFrame, songs: DataFrame, folder: str, artist_rows=ARTIST_ROWS) -> None:
    """The lake variant as Parquet tables below a folder, each published in one step.

    Plays and times lie in folders by year and month. Songs lie in folders by
    year and bucket of the artist: the buckets follow the rows, so folders and
    files do not grow in number with the artists.
    """
    spark = log.sparkSession
    song_rows = songs_table(songs)
    buckets = max(1, -(-song_rows.count() // artist_rows))
    bucketed = song_rows.withColumn("artist_bucket", artist_bucket(buckets))
    _publish(bucketed, f"{folder}/songs", "year", "artist_bucket", buckets=buckets)
    _publish(artists_table(songs), f"{folder}/artists")
    _publish(users(log), f"{folder}/users")
    starts = song_plays(log).select(dates.from_millis("ts").alias("start_time"))
    _publish(time_table(starts, "name"), f"{folder}/time", "year", "month")
    plays = with_time(songplays(log, songs, "lake"), read_state(spark, f"{folder}/time"))
    _publish(plays, f"{folder}/songplays", "year", "month")


def _publish(df, root, *partition_by, **notes):
    spark = df.sparkSession
    state = newest(spark, root)
    part = stage(df, root, *partition_by)
    publish(spark, root, state.number + 1 if state else 0, {part: part}, **notes)


def lake_table(spark, folder: str, name: str) -> DataFrame:
    return read_state(spark, f"{folder}/{name}")


def artist_songs(spark, folder: str, artist) -> DataFrame:
    """Songs of an artist; only the artist's bucket is read."""
    buckets = newest(spark, f"{folder}/songs").notes["buckets"]
    rows = lake_table(spark, folder, "songs")
    wanted = artist_bucket(buckets, F.lit(artist))
    return rows.where((F.col("artist_bucket") == wanted) & (F.col("artist_id") == artist)).drop("artist_bucket")
