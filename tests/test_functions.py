import datetime as dt
import hashlib

from pyspark.sql import functions as F

from starloom.functions import dates, text
from starloom.functions.keys import add_dense_keys, hash_key
from starloom.functions.money import cents_to_money, hundredths, net_units, units_to_money
from tests.conftest import rows, ts


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_millis(spark):
    got = one(spark, dates.from_millis(F.lit(1541105830796)), dates.from_millis_whole_seconds(F.lit(1541105830796)))
    assert got == (ts("2018-11-01 20:57:10.796"), ts("2018-11-01 20:57:10"))


def test_weekday_conventions(spark):
    sunday = F.lit("2018-11-04").cast("date")
    got = one(spark, *[dates.weekday(sunday, c) for c in ("mon0", "sun0", "iso", "name")], dates.is_weekend(sunday))
    assert got == (6, 0, 7, "Sun", True)


def test_iso_week_of_last_december_day(spark):
    day = F.lit("2018-12-31").cast("date")
    got = one(spark, dates.time_parts(day)["week"], dates.iso_week_text(day), dates.date_key(day))
    assert got == (1, "01", 20181231)


def test_intervals(spark):
    start, end = F.lit("2020-01-01").cast("date"), F.lit("2020-01-09").cast("date")
    got = one(
        spark,
        dates.days_late(start, end, F.lit(3)),
        dates.days_late(start, end, F.lit(10)),
        dates.month_start_before(F.lit("2020-05-31").cast("date"), 3),
    )
    assert got == (5, 0, dt.date(2020, 2, 1))


def test_log_time_and_day_number(spark):
    got = one(
        spark,
        dates.log_time(F.lit("01/Aug/1995:00:00:01 -0400")),
        dates.log_time(F.lit("nonsense")),
        dates.day_number_date(F.lit(20636.0)),
    )
    assert got == (ts("1995-08-01 04:00:01"), None, dt.date(2016, 7, 1))


def test_access_log_map(spark):
    lines = [
        ('h.com - u [01/Aug/1995:00:00:01 -0400] "GET /a b HTTP/1.0" 200 12',),
        ('h.com - - [01/Aug/1995:00:00:01 -0400] "GET /a" 304 -',),
        ("garbage",),
        (None,),
    ]
    got = spark.createDataFrame(lines, "value string").select(text.access_log_map(F.col("value")).alias("m")).collect()
    assert got[0].m is None  # three words after the method do not fit the pattern
    assert got[1].m["content_size"] == "0" and got[1].m["protocol"] == "" and got[1].m["response_code"] == "304"
    assert got[2].m is None and got[3].m is None


def test_pattern_parts_with_marks_in_the_line(spark):
    lines = [("ab-12",), ("x ab-12 y",), ("a\x1fb-1",), ("\x1f1\x1f2",), ("a\nb-3\nz",), ("-",), (None,)]
    parts = text.pattern_parts("value", r"([a-z]+)-(\d+)", 2)
    got = [r[0] for r in spark.createDataFrame(lines, "value string").select(parts).collect()]
    assert got == [["ab", "12"], ["ab", "12"], ["b", "1"], None, ["b", "3"], None, None]


def test_names(spark):
    got = one(
        spark,
        text.full_name(F.lit("ANN"), F.lit("LEE")),
        text.full_name(F.lit("ANN"), F.lit(None).cast("string")),
        text.capitalised(F.lit("mARY ann")),
        text.active_note(F.lit(False)),
        text.md5_key(F.lit(12), F.lit("x")),
    )
    assert got == ("ANN LEE", None, "Mary ann", "", hashlib.md5(b"12x").hexdigest())


def test_money(spark):
    df = spark.createDataFrame([(0.1, 0.05), (1.15, 0.1), (-2.5, 0.0)], "l_extendedprice double, l_discount double")
    got = df.agg(units_to_money(F.sum(net_units())), cents_to_money(F.sum(hundredths("l_extendedprice").cast("decimal(18,0)"))))
    assert got.first() == (-1.37, -1.25)


def test_dense_keys_are_complete_and_stable(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("k"))
    keyed = add_dense_keys(df, "k", "n", start=5, bucket_rows=30)
    assert sorted(r.n for r in keyed.collect()) == list(range(5, 1005))
    again = add_dense_keys(df.repartition(3), "k", "n", start=5, bucket_rows=30)
    assert rows(keyed) == rows(again)


def test_hash_key_is_the_same_for_equal_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "x string, y int").select(hash_key("x", "y").alias("h"))
    assert df.distinct().count() == 2
