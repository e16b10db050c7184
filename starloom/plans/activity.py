"""Questions on a user-event log with ``userId, ts, page, artist, gender``."""

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.aggregate import group_count, top_k, top_with_ties
from starloom.operators.clean import drop_missing
from starloom.operators.joins import anti_values
from starloom.operators.periods import flag_phase, period_average


def valid_rows(log: DataFrame, user="userId", session="sessionId") -> DataFrame:
    """Rows with a user and a session; logged-out rows have a blank user."""
    return drop_missing(log, required=[user, session], not_blank=[user])


def plays_by_hour(log: DataFrame, ts="ts", page="page", play="NextSong") -> DataFrame:
    """Plays of each hour of the day, in the order of the hours."""
    return group_count(log.where(F.col(page) == play), F.hour(ts).alias("hour")).orderBy("hour")


def pages_not_visited(log: DataFrame, who: Column, page="page") -> DataFrame:
    """Pages in the log that the chosen rows never show, in order."""
    return anti_values(log, log.where(who), page).orderBy(page)


def distinct_users(log: DataFrame, who: Column, user="userId") -> DataFrame:
    return log.where(who).agg(F.count_distinct(user).alias("users"))


def most_played(log: DataFrame, artist="artist", ties=False) -> DataFrame:
    """The artist with most plays; with ``ties`` all that share the first place."""
    plays = group_count(log, artist, name="plays", column=artist)
    return top_with_ties(plays, "plays") if ties else top_k(plays, "plays", 1, artist)


def downgrade_phase(log: DataFrame, frame="range", **options) -> DataFrame:
    """Each row's number of downgrades still to come (its own included)."""
    return flag_phase(log, "userId", "ts", F.col("page") == "Submit Downgrade", frame, **options)


def songs_between_homes(log: DataFrame, **options) -> DataFrame:
    """Average number of songs a user plays between visits to the home page."""
    return period_average(log, "userId", "ts", F.col("page") == "NextSong", F.col("page") == "Home", **options)
