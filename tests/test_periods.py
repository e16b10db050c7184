"""Phases and periods against a plain window and hand-counted cases."""

import pytest
from pyspark.sql import Window, functions as F

from starloom.operators.periods import flag_phase, period_average, period_counts
from starloom.operators.prefix import PART, carried_sums, place, running_sums
from starloom.plans import activity
from tests.conftest import rows

SCHEMA = "id int, userId string, ts long, page string"


@pytest.fixture(scope="module")
def log(spark):
    data = [
        (1, "u", 10, "NextSong"),
        (2, "u", 20, "Home"),
        (3, "u", 30, "NextSong"),
        (4, "u", 30, "Home"),  # same time as 3
        (5, "u", 40, "NextSong"),
        (6, "u", 45, "NextSong"),
        (7, "v", 50, "NextSong"),
        (8, None, 10, "Home"),
        (9, None, 5, "NextSong"),
        (10, "w", None, "NextSong"),
        (11, "w", 3, "Home"),
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(params=[1, 3, 24])
def parts(spark, request):
    """The number of range partitions, which Spark otherwise merges for small tables."""
    changed = {
        "spark.sql.shuffle.partitions": str(request.param),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in old.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_equals_the_single_window(log, parts, frame):
    window = Window.partitionBy("userId").orderBy(F.desc("ts"), *(["id"] if frame == "rows" else []))
    if frame == "range":
        window = window.rangeBetween(Window.unboundedPreceding, 0)
    else:
        window = window.rowsBetween(Window.unboundedPreceding, 0)
    flag = (F.col("page") == "Home").cast("int")
    expected = log.withColumn("phase", F.sum(flag).over(window))
    got = flag_phase(log, "userId", "ts", F.col("page") == "Home", frame, ["id"])
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "double"])
def test_kinds_of_time(spark, parts, kind):
    df = spark.range(500).select(
        "id",
        (F.col("id") % 2).alias("u"),
        (F.timestamp_millis(F.lit(1541105830000) + F.col("id") * 137 % 5000) if kind != "double" else F.col("id") * 137 % 5000)
        .cast(kind)
        .alias("t"),
    )
    window = Window.partitionBy("u").orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("phase", F.sum((F.col("id") % 5 == 0).cast("int")).over(window))
    assert rows(flag_phase(df, "u", "t", F.col("id") % 5 == 0)) == rows(expected)


def test_range_and_rows_differ_on_ties(log, parts):
    flag = F.col("page") == "Home"
    by_range = dict(rows(flag_phase(log, "userId", "ts", flag, "range").select("id", "phase")))
    by_rows = dict(rows(flag_phase(log, "userId", "ts", flag, "rows", ["id"]).select("id", "phase")))
    assert (by_range[3], by_rows[3]) == (1, 0)


def test_period_counts(log, parts):
    item, marker = F.col("page") == "NextSong", F.col("page") == "Home"
    known = log.where("userId = 'u'")
    assert rows(period_counts(known, "userId", "ts", item, marker)) == [("u", 0, 2), ("u", 1, 1), ("u", 2, 1)]
    closed = period_counts(known, "userId", "ts", item, marker, closed_only=True)
    assert rows(closed) == [("u", 1, 1)]
    assert period_average(known, "userId", "ts", item, marker).first()[0] == pytest.approx(4 / 3)


def test_several_sums_of_several_types(spark, parts):
    df = spark.range(300).select("id", (F.col("id") % 3).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("b"))
    sums = {"n": F.lit(1), "total": F.col("id").cast("decimal(20,0)"), "odd": F.when(F.col("id") % 2 == 1, 1)}
    got = running_sums(df, ["a", "b"], ["id"], sums)
    window = Window.partitionBy("a", "b").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumns({name: F.coalesce(F.sum(column).over(window), F.lit(0)) for name, column in sums.items()})
    assert rows(got) == rows(expected.select(got.columns))


def test_empty_table(spark):
    df = spark.range(0).select(F.lit(1).alias("u"), F.col("id").alias("t"))
    assert running_sums(df, ["u"], ["t"], {"n": F.lit(1)}).count() == 0


def test_no_window_holds_a_whole_user(log):
    """Rows are windowed per partition; only one row per partition is windowed per user."""
    df = flag_phase(log, "userId", "ts", F.col("page") == "Home", "range")
    windows = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert len(windows) == 2
    assert f"{PART}#" in windows[0].split("], [")[1] and f"{PART}#" not in windows[1].split("], [")[1]


@pytest.fixture
def many_parts(spark):
    changed = {"spark.sql.shuffle.partitions": "1500", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def test_a_user_fills_any_number_of_partitions(spark, many_parts):
    """One user has nearly all rows, 95 % of them in a burst: the rows are cut evenly, beyond any fixed number of pieces."""
    burst = spark.range(30_000).select(
        F.lit(1).alias("u"), F.when(F.col("id") < 28_500, F.col("id")).otherwise(F.col("id") * 10**6).alias("t")
    )
    few = spark.range(300).select(F.lit(2).alias("u"), F.col("id").alias("t"))
    placed = place(burst.union(few), ["u"], ["t"])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    sizes = [r["count"] for r in placed.where("u = 1").groupBy(PART).count().collect()]
    assert len(sizes) > 1_200 and max(sizes) <= 200 and sum(sizes) == 30_000
    carried = carried_sums(placed.withColumn("n", F.lit(1)), ["u"], ["n"]).where("u = 1")
    assert carried.agg(F.count("*"), F.max("n")).first()[0] == len(sizes) - 1


def test_one_time_stays_in_one_partition(spark, parts):
    df = spark.range(1000).select(F.lit(1).alias("u"), (F.col("id") % 3).alias("t"))
    assert place(df, ["u"], ["t"]).select("t", PART).distinct().count() == 3


def test_activity(spark):
    data = [
        ("1", 5, 1000, "NextSong", "A", "F"),
        ("1", 5, 2000, "Submit Downgrade", None, "F"),
        ("2", 6, 3000, "NextSong", "A", "M"),
        ("2", 6, 4000, "NextSong", "B", "M"),
        ("", 7, 5000, "Home", None, None),
        (None, 7, 6000, "Help", None, None),
    ]
    log = spark.createDataFrame(data, "userId string, sessionId int, ts long, page string, artist string, gender string")
    assert activity.valid_rows(log).count() == 4
    assert rows(activity.pages_not_visited(log, F.col("userId") == "")) == [("Help",), ("NextSong",), ("Submit Downgrade",)]
    assert activity.distinct_users(log, F.col("gender") == "F").first()[0] == 1
    assert rows(activity.most_played(log)) == [("A", 2)]
    phase = activity.downgrade_phase(activity.valid_rows(log)).select("ts", "phase")
    assert rows(phase) == [(1000, 1), (2000, 1), (3000, 0), (4000, 0)]
    assert activity.songs_between_homes(log).first()[0] == 1.5
