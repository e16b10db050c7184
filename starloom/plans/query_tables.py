"""Event history as one table per question."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.text import full_name
from starloom.operators.query_table import lookup_stored, store_query_table
from starloom.operators.writes import write_csv
from starloom.sources.files import scan_event_csv

# The columns kept of the daily event files, in order.
EVENT_COLUMNS = [
    "artist",
    "firstName",
    "gender",
    "itemInSession",
    "lastName",
    "length",
    "level",
    "location",
    "sessionId",
    "song",
    "userId",
]


def event_history(spark: SparkSession, folder) -> DataFrame:
    """The daily files as one typed table, without rows that name no artist."""
    return scan_event_csv(spark, folder, EVENT_COLUMNS, "artist").withColumns(
        {
            "itemInSession": F.col("itemInSession").try_cast("int"),
            "sessionId": F.col("sessionId").try_cast("int"),
            "userId": F.col("userId").try_cast("int"),
            "length": F.col("length").try_cast("float"),
        }
    )


def write_history(events: DataFrame, path) -> None:
    write_csv(events, path, quote_all=True)


def named_events(events: DataFrame) -> DataFrame:
    return events.withColumn("user_name", full_name("firstName", "lastName"))


# The table of each question: partition columns, clustering columns, other columns.
SESSION_ITEMS = (["sessionId"], ["itemInSession"], ["artist", "song", "length"])
USER_SESSIONS = (["userId", "sessionId"], ["itemInSession"], ["artist", "song", "user_name"])
SONG_USERS = (["song"], ["userId"], ["user_name"])


def store_tables(events: DataFrame, root, order_by) -> None:
    """Write the three tables below ``root``; of rows that share a key the last by ``order_by`` stays."""
    events = named_events(events)
    for name, layout in {"session_items": SESSION_ITEMS, "user_sessions": USER_SESSIONS, "song_users": SONG_USERS}.items():
        store_query_table(events, f"{root}/{name}", *layout, order_by)


def session_item(spark: SparkSession, root, session, item) -> DataFrame:
    """Artist, song and length of an item of a session."""
    found = lookup_stored(spark, f"{root}/session_items", sessionId=session, itemInSession=item)
    return found.select("artist", "song", "length")


def user_session(spark: SparkSession, root, user, session) -> DataFrame:
    """Songs of a user's session in the order played."""
    found = lookup_stored(spark, f"{root}/user_sessions", userId=user, sessionId=session)
    return found.orderBy("itemInSession").select("itemInSession", "artist", "song", "user_name")


def song_users(spark: SparkSession, root, song) -> DataFrame:
    """Users who heard a song."""
    return lookup_stored(spark, f"{root}/song_users", song=song).select("userId", "user_name")
