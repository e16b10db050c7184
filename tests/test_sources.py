import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from starloom.plans import payments, query_tables
from starloom.schemas import SCHEMAS, empty_table, schema
from starloom.sources import files
from starloom.sources.labels import parse_label_blocks, parse_labels
from tests.conftest import rows, ts


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_json_with_schema_over_nested_folders(spark, tmp_path):
    for n, folder in enumerate(["A/A/A", "A/B/C"]):
        write_lines(tmp_path / folder / f"{n}.json", [json.dumps({"song_id": f"S{n}", "title": "t", "year": 0})])
    write_lines(tmp_path / "A/readme.txt", ["no json"])
    by_glob = files.scan_json(spark, f"{tmp_path}/*/*/*/*.json", schema("song_files"))
    by_walk = files.scan_json(spark, str(tmp_path), schema("song_files"), recursive=True, pattern="*.json")
    assert rows(by_glob.select("song_id", "title", "duration")) == [("S0", "t", None), ("S1", "t", None)]
    assert rows(by_walk) == rows(by_glob)
    assert [r.records for r in files.rows_per_file(by_walk).collect()] == [1, 1]


def test_json_keys_of_any_case(spark, tmp_path):
    write_lines(tmp_path / "a.json", ['{"Song_ID": "S", "YEAR": 3, "year": 4, "Duration": 1.5, "other": {"x": 1}}', '{"year": "x"}'])
    df = files.scan_json_any_case(spark, str(tmp_path), schema("song_files"))
    assert rows(df.select("song_id", "year", "duration", "title")) == [("S", 3, 1.5, None), (None, None, None, None)]


def test_json_inferred(spark, tmp_path):
    write_lines(tmp_path / "p.json", [json.dumps({"data": {"title": "x", "author": "y"}})])
    assert files.scan_json(spark, str(tmp_path)).select("data.title").first()[0] == "x"


def test_json_paths_in_order_with_epoch_millis(spark, tmp_path):
    write_lines(tmp_path / "e.json", [json.dumps({"b": {"c": {"d": 3}, "e": "z"}, "ts": 1541105830796})])
    mapping = [("ts", "start", "timestamp"), ("b.c.d", "d", "int"), ("b.e", "e", "string"), ("none", "gone", "int")]
    df = files.stage_json(spark, str(tmp_path), mapping, time_columns=["start"])
    assert df.columns == ["start", "d", "e", "gone"]
    assert df.first() == (ts("2018-11-01 20:57:10.796"), 3, "z", None)


def test_csv_forms(spark, tmp_path):
    write_lines(tmp_path / "t.csv", ["a;b", "1;x", "2;y"])
    typed = files.stage_csv(spark, str(tmp_path), "a int, b string", sep=";")
    assert rows(typed) == [(1, "x"), (2, "y")]
    assert files.stage_csv(spark, str(tmp_path), sep=";").dtypes == [("a", "string"), ("b", "string")]


def test_csv_skips_lines_of_every_file(spark, tmp_path):
    for n in range(2):
        write_lines(tmp_path / f"{n}.csv", ["comment", "a,b", f"{n},x", f"{n},y"])
    df = files.stage_csv(spark, str(tmp_path), "a int, b string", skip_lines=2)
    assert rows(df) == [(0, "x"), (0, "y"), (1, "x"), (1, "y")]


def test_gzip_is_spread(spark, tmp_path):
    (tmp_path / "t.gz").write_bytes(gzip.compress(b"id;price\n1;2.50\n2;3.00\n"))
    df = files.stage_csv(spark, str(tmp_path), "id int, price decimal(8,2)", sep=";", partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 2


def test_event_csv(spark, tmp_path):
    header = (
        "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,registration,"
        "sessionId,song,status,ts,userId"
    )
    write_lines(
        tmp_path / "d.csv",
        [header, "Ar,L,Ann,F,1,Lee,10.5,free,X,PUT,NextSong,1E12,7,So,200,1E12,3", ",L,Bob,M,2,Lee,,free,X,GET,Home,1E12,7,,200,1E12,4"],
    )
    events = query_tables.event_history(spark, str(tmp_path))
    assert rows(events) == [("Ar", "Ann", "F", 1, "Lee", 10.5, "free", "X", 7, "So", 3)]
    query_tables.write_history(events, str(tmp_path / "out"))
    assert '"Ar","Ann"' in "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    query_tables.store_tables(events, str(tmp_path / "tables"), ["length"])
    root = str(tmp_path / "tables")
    assert rows(query_tables.user_session(spark, root, 3, 7)) == [(1, "Ar", "So", "Ann Lee")]
    assert rows(query_tables.song_users(spark, root, "So")) == [(3, "Ann Lee")]
    assert rows(query_tables.session_item(spark, root, 7, 1)) == [("Ar", "So", 10.5)]
    assert rows(query_tables.session_item(spark, root, 7, 2)) == []


def test_skipped_lines_run_on_into_the_next_block(spark, tmp_path):
    """Blocks so small that the lines to skip fill several of them; the lines that stay keep their number."""
    write_lines(tmp_path / "a.csv", [f"head {n};" + "x" * 50 for n in range(40)] + [f"{n};x" for n in range(500)])
    write_lines(tmp_path / "b.csv", ["h", "h"])
    write_lines(tmp_path / "c.csv", [f"{n};c" for n in range(45)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")
    try:
        df = files.stage_csv(spark, str(tmp_path), "a int, b string", sep=";", skip_lines=40)
        assert rows(df.where("b = 'x'")) == [(n, "x") for n in sorted(range(500), key=lambda n: repr((n, "x")))]
        assert rows(df.where("b = 'c'")) == [(n, "c") for n in range(40, 45)] and df.count() == 505
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_skipping_lines_does_not_sort_them(spark, tmp_path):
    write_lines(tmp_path / "a.csv", ["h", "h", "1,x"])
    plan = files.stage_csv(spark, str(tmp_path), "a int, b string", skip_lines=2)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "value#" not in windows[0] and "sum(lines#" in windows[0]


def test_parquet_leaf_glob_keeps_partitions(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2000), (2, "b", 2001)], "id int, k string, year int").write.partitionBy("year", "k").parquet(
        str(tmp_path / "t")
    )
    df = files.scan_parquet(spark, str(tmp_path / "t/*/*"), base_path=str(tmp_path / "t"))
    assert rows(df.select("id", "year", "k")) == [(1, 2000, "a"), (2, 2001, "b")]
    assert rows(files.month_slice(df.withColumn("month", F.lit(3)), dt.date(2001, 3, 9)).select("id")) == [(2,)]


def test_month_path():
    assert files.month_path("s/{year}/{month}/f.csv", dt.date(2018, 3, 1)) == "s/2018/3/f.csv"


def test_labels(spark):
    lines = spark.createDataFrame([("'ALC'\t=\t'ALCAN, AK   '",), ("nothing",)], "value string")
    assert rows(parse_labels(lines)) == [("ALC", "ALCAN, AK   ")]


def test_label_blocks(spark, tmp_path):
    write_lines(
        tmp_path / "labels.txt",
        ["/* text */", "value i94model", "\t1 = 'Air'", "\t9 = 'Not reported' ;", "", "  value $state", "\t'AL'='ALABAMA'"],
    )
    blocks = parse_label_blocks(files.scan_lines(spark, str(tmp_path)))
    assert rows(blocks.select("block", "code", "label")) == [
        ("i94model", "1", "Air"),
        ("i94model", "9", "Not reported"),
        ("state", "AL", "ALABAMA"),
    ]


def test_describe_and_literals(spark):
    df = files.literal_rows(spark, [(1, "x")], "a int, b string")
    assert rows(files.describe_table(df).select("column_name", "data_type")) == [("a", "int"), ("b", "string")]


def test_payments(spark, tmp_path):
    write_lines(
        tmp_path / "p.csv",
        ["payment_id;customer_id;staff_id;rental_id;amount;payment_date", "1;2;1;3;0.99;2007-01-24", "2;2;1;4;1.98;2007-01-25", "3;2;1;4;x;2007-02-25"],
    )
    typed = payments.monthly_revenue(payments.read_payments(spark, str(tmp_path)))
    assert [(m, float(r) if r is not None else None) for m, r in rows(typed)] == [(1, 2.97), (2, None)]
    assert payments.read_payments_untyped(spark, str(tmp_path)).dtypes[4:] == [("amount", "double"), ("payment_date", "timestamp")]


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_schemas(spark, name):
    assert empty_table(spark, name).schema == schema(name)
