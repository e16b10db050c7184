import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import aggregate, clean, cubes, joins, quality
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Cleaning


def test_drop_missing(spark):
    df = spark.createDataFrame([("a", "1"), ("", "1"), (None, "1"), ("b", "NaN"), ("c", None)], "u string, t string")
    assert rows(clean.drop_missing(df, required=["u"], not_blank=["u"], not_nan_text=["t"])) == [("a", "1")]


def test_cast_columns_gives_null_for_bad_text(spark):
    df = spark.createDataFrame([("12",), ("",), ("x",)], "n string")
    assert rows(clean.cast_columns(df, {"n": "int"})) == [(12,), (None,), (None,)]


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (None, 2, "b"), (None, 5, "z")], "k int, t int, v string")
    assert rows(clean.first_per_key(df, "k", ["t"])) == [(1, 1, "a"), (None, 2, "b")]
    assert rows(clean.last_per_key(df, ["k"], ["t"])) == [(1, 3, "c"), (None, 5, "z")]


def test_first_per_key_cuts_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2)], "k int, t int")
    text = plan(clean.first_per_key(df, "k", ["t"]))
    assert text.count("WindowGroupLimit") == 2


def test_ranges(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (1945,), (1946,), (2000,), (2001,), (2010,)], "y int")
    older, younger = clean.split_by_range(df, "y", 0, 1945, 2000)
    assert rows(older) == [(1,), (1945,)] and rows(younger) == [(2001,), (2010,)]
    assert clean.range_extremes(df, "y", 0, 1945, 2000).first() == (1, 2010)


# Joins


def test_contains_lookup_takes_first_label(spark):
    labels = spark.createDataFrame(
        [(2, "B", "NEW YORK, NY  "), (1, "A", "York Harbor"), (3, "C", "x")], "line int, code string, label string"
    )
    cities = spark.createDataFrame([("york",), ("New York",), ("",), ("Paris",), (None,), ("X",)], "city string")
    got = dict(rows(joins.contains_lookup(cities, "city", labels, "label", "code", "line")))
    assert got == {"york": "A", "New York": "B", "": "A", "Paris": None, None: None, "X": "C"}


def test_contains_lookup_against_a_loop(spark):
    rng = random.Random(3)

    def word(low, high):
        return "".join(rng.choice("abA %_") for _ in range(rng.randint(low, high)))

    labels = [(n, f"C{n}", word(0, 9)) for n in rng.sample(range(100), 40)]
    cities = sorted({word(0, 4) for _ in range(300)})
    expected = {
        city: next((code for _, code, label in sorted(labels) if city.lower() in label.lower()), None) for city in cities
    }
    got = joins.contains_lookup(
        spark.createDataFrame([(c,) for c in cities], "city string"),
        "city",
        spark.createDataFrame(labels, "line int, code string, label string"),
        "label",
        "code",
        "line",
    )
    assert dict(rows(got)) == expected


def test_contains_lookup_of_empty_label(spark):
    labels = spark.createDataFrame([(1, "E", "")], "line int, code string, label string")
    cities = spark.createDataFrame([("",), ("a",)], "city string")
    assert rows(joins.contains_lookup(cities, "city", labels, "label", "code", "line")) == [("", "E"), ("a", None)]


def test_contains_lookup_has_no_cross_join(spark):
    labels = spark.createDataFrame([(1, "A", "York")], "line int, code string, label string")
    cities = spark.createDataFrame([("york",)], "city string")
    text = plan(joins.contains_lookup(cities, "city", labels, "label", "code", "line"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_anti_values_with_null(spark):
    universe = spark.createDataFrame([("a",), ("b",), (None,), ("b",)], "p string")
    seen = spark.createDataFrame([("a",), (None,)], "p string")
    assert rows(joins.anti_values(universe, seen, "p")) == [("b",)]


def test_join_two_counts(spark):
    trips = spark.createDataFrame(
        [(1, "one", 2), (1, "one", 2), (1, "uno", 1), (3, "three", 2)], "f int, n string, t int"
    )
    got = joins.join_two_counts(trips, "f", "n", "t")
    assert rows(got) == [(1, "one", 3, 1), (1, "uno", 3, 1)]


# Aggregates


def test_counts_ties_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "x string")
    counts = aggregate.group_count(df, "x", name="n", column="x")
    assert rows(counts) == [("a", 2), ("b", 2), ("c", 1), (None, 0)]
    assert rows(aggregate.top_with_ties(counts, "n")) == [("a", 2), ("b", 2)]
    assert rows(aggregate.top_k(counts, "n", 1, "x")) == [("a", 2)]
    assert rows(aggregate.top_k(df.distinct(), "x", 1, nulls_first=True)) == [(None,)]
    assert rows(aggregate.top_k(df.distinct(), "x", 1)) == [("c",)]
    assert rows(aggregate.average_group_count(df, ["x"])) == [(1.5,)]
    assert rows(aggregate.table_counts({"t": df, "e": df.limit(0)})) == [("e", 0), ("t", 6)]


def test_concat_by(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    assert rows(aggregate.concat_by(df, ["k"], F.col("v"), "s")) == [(1, "a, b, b"), (2, None)]
    assert rows(aggregate.concat_by(df, ["k"], F.col("v"), "s", sep="'", distinct=True)) == [(1, "a'b"), (2, None)]
    assert rows(aggregate.concat_by(df, ["k"], F.col("v"), "s", sep="'")) == [(1, "a'b'b"), (2, None)]


def test_word_count(spark):
    df = spark.createDataFrame([("a b  a",), (None,)], "t string")
    assert rows(aggregate.word_count(df, "t")) == [("a", 2), ("b", 1)]


def test_statistics(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a int, b double")
    assert rows(aggregate.summary_statistics(df, "a", "b"))[1] == ("b", 1, 2.0, None, 2.0, 2.0)


# Cubes


@pytest.fixture(scope="module")
def star(spark):
    data = [("x", 1, 10), ("x", 2, 20), (None, 1, 5), ("y", None, 7)]
    return spark.createDataFrame(data, "city string, month int, amount int")


def test_three_forms_of_the_cube_agree_with_null_values(star):
    dims, sets = ["month", "city"], [[], ["month"], ["city"], ["month", "city"]]
    a = cubes.grouping_sets(star, dims, sets, "amount")
    b = cubes.cube_totals(star, dims, "amount")
    c = cubes.union_totals(star, dims, sets, "amount")
    assert rows(a) == rows(b) == rows(c)
    assert (None, None, 3, 42) in rows(a) and (1, None, 1, 15) in rows(a) and (1, None, 0, 5) in rows(a)


def test_cells(star):
    dims = ["month", "city"]
    assert rows(cubes.slice_cube(star, dims, "amount", "city", "x")) == [(1, "x", 10), (2, "x", 20)]
    assert rows(cubes.dice_cube(star, dims, "amount", {"city": ["x", "y"], "month": [1]})) == [(1, "x", 10)]


def test_levels():
    levels = ["district", "city", "country"]
    assert cubes.change_level(["day", "city"], levels, 1) == ["day", "country"]
    assert cubes.change_level(["day", "city"], levels, -1) == ["day", "district"]
    with pytest.raises(ValueError):
        cubes.change_level(["country"], levels, 1)


# Quality


def test_checks(spark):
    df = spark.createDataFrame([(1, "G", 1950), (1, "Q", None), (None, None, 2200)], "id int, r string, y int")
    parent = spark.createDataFrame([(2,)], "pid int")
    report = quality.all_checks(
        quality.check_rows(df, "t"),
        quality.check_rows(df.limit(0), "empty"),
        quality.check_columns(
            df, "t", quality.not_null("id") | quality.in_values("r", ["G"]) | quality.in_range("y", 1901, 2155)
        ),
        quality.check_unique(df, "t", ["id"]),
        quality.check_foreign_key(df, "id", parent, "pid", "t"),
        quality.check_expected([("count", df.agg(F.count("*")), 3), ("null", df.agg(F.max(F.lit(None))), None)]),
    )
    assert rows(report) == [
        ("count", 0, True),
        ("empty: has rows", 1, False),
        ("null", 0, True),
        ("t: has rows", 0, True),
        ("t: id in parent", 2, False),
        ("t: id not null", 1, False),
        ("t: id unique", 1, False),
        ("t: r in domain", 1, False),
        ("t: y in range", 1, False),
    ]
    with pytest.raises(quality.DataQualityError, match="empty: has rows"):
        quality.enforce(report)
    quality.enforce(report.where("passed"))


def test_check_tables(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "full"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    report = quality.check_tables(spark, {n: str(tmp_path / n) for n in ("full", "empty", "missing")})
    assert rows(report) == [("empty: has rows", 1, False), ("full: has rows", 0, True), ("missing: has rows", 1, False)]


def test_star_join(spark):
    fact = spark.createDataFrame([(1, 10, 5), (2, 11, 6), (1, 99, 7)], "d int, m int, amount int")
    days = spark.createDataFrame([(1, "Mon"), (2, "Tue")], "day_key int, day string")
    movies = spark.createDataFrame([(10, "PG"), (11, "G")], "movie_key int, rating string")
    star = joins.star_join(fact, (days, "d", "day_key"), (movies, "m", "movie_key"))
    assert rows(star.select("day", "rating", "amount")) == [("Mon", "PG", 5), ("Tue", "G", 6)]


def test_count_report_and_primary_key(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(quality.count_report({"t": df, "e": df.limit(0)})) == [("e", 0, False), ("t", 2, True)]
    quality.enforce(quality.check_primary_key(df, "t", ["id"]))
