"""Keyed loads, table writes and scheduled loads; every load is run twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import keyed_state, layout, snapshots, upsert, writes
from starloom.plans import bikes
from starloom.operators.quality import DataQualityError
from starloom.session import work_folder
from starloom.streaming.incremental import backfill, load_partition, run_months
from starloom.streaming.ingest import upsert_stream
from tests.conftest import rows, ts

USERS = "user_id string, name string, level string"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([("1", "Ann", "free"), ("2", "Bob", "paid")], USERS)


@pytest.fixture(scope="module")
def new(spark):
    data = [("2", "Robert", "free", 1), ("3", "Cy", "free", 2), ("3", "Cyril", "paid", 3), ("1", None, None, 4)]
    return spark.createDataFrame(data, USERS + ", ts long")


def test_upsert_updates_chosen_columns_only(target, new):
    got = upsert.upsert(target, new, ["user_id"], ["level"], ["ts"])
    assert rows(got) == [("1", "Ann", None), ("2", "Bob", "free"), ("3", "Cy", "paid")]
    assert rows(upsert.upsert(got, new, ["user_id"], ["level"], ["ts"])) == rows(got)
    null_key = new.withColumn("user_id", F.lit(None).cast("string"))
    once = upsert.upsert(target, null_key, ["user_id"], ["level"], ["ts"])
    assert once.count() == 3 and rows(upsert.upsert(once, null_key, ["user_id"], ["level"], ["ts"])) == rows(once)
    assert rows(upsert.upsert(target, new.limit(0), ["user_id"], ["level"], ["ts"])) == rows(target)


def test_insert_ignore(target, new):
    got = upsert.insert_ignore(target, new, ["user_id"], ["ts"])
    assert rows(got) == [("1", "Ann", "free"), ("2", "Bob", "paid"), ("3", "Cy", "free")]
    assert rows(upsert.insert_ignore(got, new, ["user_id"], ["ts"])) == rows(got)


def test_last_write(new):
    assert rows(upsert.last_write(new, ["user_id"], ["ts"]).select("user_id", "level")) == [("1", None), ("2", "free"), ("3", "paid")]


def test_query_table_is_ordered_and_splits_a_large_key(spark):
    df = spark.range(20000).select(F.lit(1).alias("session"), (19999 - F.col("id")).alias("item"), F.lit("s").alias("song"))
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        table = upsert.build_query_table(df, ["session"], ["item"], ["song"])
        parts = table.select(F.spark_partition_id().alias("p"), "item").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert len(parts) == 8
    assert [r.item for r in table.take(3)] == [0, 1, 2]


def test_load_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    for _ in range(2):
        writes.load_table(df, path)
    assert writes.read_loaded(spark, path).count() == 3
    assert writes.load_table(df, path, "append").count() == 6
    with pytest.raises(ValueError):
        writes.load_table(df, path, "merge")


def test_a_load_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table = writes.load_table(spark.range(3), path)
    table = writes.load_table(table.select(F.col("id") + 1).toDF("id"), path)
    assert rows(writes.load_table(table, path, "append")) == [(1,), (1,), (2,), (2,), (3,), (3,)]


@pytest.mark.parametrize("mode", ["overwrite", "append"])
@pytest.mark.parametrize("point", ["write", "publish", "half a list"])
def test_a_load_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch, mode, point):
    """The load dies while it writes rows, before it publishes them, or in the middle of the list."""
    path = str(tmp_path / "t")
    writes.load_table(spark.range(3), path)
    rows_ = spark.range(10, 20)
    if point == "write":
        rows_ = rows_.select(F.when(F.col("id") < 19, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
        with pytest.raises(Exception, match="lost"):
            writes.load_table(rows_, path, mode)
    else:
        with monkeypatch.context() as patch:
            patch.setattr(snapshots, "publish", lambda *a, **b: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(OSError):
                writes.load_table(rows_, path, mode)
        if point == "half a list":
            (tmp_path / "t/_states/000000000001.json").write_text('{"number": 1, "parts": {"data')
    assert len(list((tmp_path / "t/data").iterdir())) == 2  # The rows that count for nothing.
    assert rows(writes.read_loaded(spark, path)) == [(0,), (1,), (2,)]
    writes.load_table(spark.range(10, 20), path, mode)
    assert writes.read_loaded(spark, path).count() == (10 if mode == "overwrite" else 13)


def test_of_two_writers_one_publishes(spark, tmp_path):
    path = str(tmp_path / "t")
    writes.load_table(spark.range(3), path)
    parts = {"a": snapshots.stage(spark.range(1), path)}
    snapshots.publish(spark, path, 1, parts)
    with pytest.raises(snapshots.StateExists):
        snapshots.publish(spark, path, 1, {"b": snapshots.stage(spark.range(2), path)})
    assert snapshots.newest(spark, path).parts == parts and snapshots.newest(spark, path, before=1).number == 0


def test_create_table(spark, tmp_path):
    path = writes.create_table(spark, str(tmp_path), "users")
    empty = writes.read_loaded(spark, path)
    writes.load_table(spark.createDataFrame([("1", "A", "L", "F", "free")], empty.schema), path, "append")
    assert writes.read_loaded(spark, writes.create_table(spark, str(tmp_path), "users")).count() == 1
    assert writes.read_loaded(spark, writes.create_table(spark, str(tmp_path), "users", replace=True)).count() == 0


def level_fold(root, number, batch, empty, buckets=16):
    merge = lambda known, new: upsert.upsert(known, new, ["user_id"], ["level"], ["ts"])
    return keyed_state.fold(root, number, batch, empty, ["user_id"], merge, buckets)


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    root, empty = str(tmp_path / "users"), spark.createDataFrame([], USERS)
    many = spark.range(500).select(F.col("id").cast("string").alias("user_id"), F.lit("n").alias("name"), F.lit("free").alias("level"), "id")
    first = level_fold(root, 0, many.withColumnRenamed("id", "ts"), empty)
    assert len(first.parts) == 16 and snapshots.read_state(spark, root).count() == 500
    files = lambda state: {b: sorted(p.name for p in (tmp_path / "users" / f).glob("*.parquet")) for b, f in state.parts.items()}
    old = files(first)
    few = spark.createDataFrame([("7", "n", "paid", 1000), ("new", "n", "paid", 1001)], USERS + ", ts long")
    touched = {r[0] for r in few.select(keyed_state.bucket_of(["user_id"], 16).cast("string")).collect()}
    second = level_fold(root, 1, few, empty)
    assert {b for b in second.parts if second.parts[b] != first.parts[b]} == touched
    assert {b for b, names in files(second).items() if names != old[b]} == touched
    expected = sorted([(str(i), "n", "paid" if i == 7 else "free") for i in range(500)] + [("new", "n", "paid")], key=repr)
    assert rows(snapshots.read_state(spark, root)) == expected
    # Each state stays readable as it was.
    assert snapshots.read_state(spark, root, first).where("level = 'paid'").count() == 0


def test_a_repeated_or_failed_fold_gives_the_same_state(spark, tmp_path, monkeypatch, target, new):
    root, empty = str(tmp_path / "users"), spark.createDataFrame([], USERS)
    level_fold(root, 0, target.withColumn("ts", F.lit(0).cast("long")), empty)
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish", lambda *a, **b: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            level_fold(root, 1, new, empty)
    assert rows(snapshots.read_state(spark, root)) == rows(target)
    states = [level_fold(root, 1, new, empty) for _ in range(2)]
    assert states[0] == states[1] and snapshots.newest(spark, root) == states[0]
    assert rows(snapshots.read_state(spark, root)) == [("1", "Ann", None), ("2", "Bob", "free"), ("3", "Cy", "paid")]


def test_null_keys_key_types_and_empty_batches(spark, tmp_path):
    root, empty = str(tmp_path / "users"), spark.createDataFrame([], USERS)
    batch = spark.createDataFrame([(5, "Ann", "free", 1), (None, "Who", "free", 1)], "user_id int, name string, level string, ts long")
    for number in range(2):
        level_fold(root, number, batch, empty)
    state = level_fold(root, 2, batch.limit(0), empty)
    assert rows(snapshots.read_state(spark, root)) == [("5", "Ann", "free"), (None, "Who", "free")]
    assert state.parts == snapshots.newest(spark, root, before=2).parts
    assert rows(keyed_state.read_key(spark, root, user_id=5)) == [("5", "Ann", "free")]
    assert rows(keyed_state.read_key(spark, root, user_id=None)) == [(None, "Who", "free")]
    missing = keyed_state.read_key(spark, root, user_id="nobody")
    assert missing is None or missing.count() == 0


def test_resize_keeps_rows_and_later_folds_use_the_new_number(spark, tmp_path):
    root, empty = str(tmp_path / "users"), spark.createDataFrame([], USERS)
    many = spark.range(100).select(F.col("id").cast("string").alias("user_id"), F.lit("n").alias("name"), F.lit("free").alias("level"), F.col("id").alias("ts"))
    level_fold(root, 0, many, empty, buckets=4)
    assert keyed_state.resize(spark, root, 32).notes["buckets"] == 32
    state = level_fold(root, 2, many.limit(1).withColumn("level", F.lit("paid")), empty, buckets=4)
    assert state.notes["buckets"] == 32 and len(state.parts) > 4
    assert snapshots.read_state(spark, root).count() == 100 and snapshots.read_state(spark, root).where("level = 'paid'").count() == 1


def test_one_key_is_read_from_one_bucket(spark, tmp_path):
    root, empty = str(tmp_path / "users"), spark.createDataFrame([], USERS)
    many = spark.range(200).select(F.col("id").cast("string").alias("user_id"), F.lit("n").alias("name"), F.lit("free").alias("level"), F.col("id").alias("ts"))
    level_fold(root, 0, many, empty)
    found = keyed_state.read_key(spark, root, user_id="42")
    assert rows(found) == [("42", "n", "free")] and len({f.rsplit("/", 1)[0] for f in found.inputFiles()}) == 1


def test_partitioned_write_is_one_file_per_small_partition(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    writes.write_partitioned(df, str(tmp_path / "t"), "k")
    assert {len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("k=*")} == {1}


def test_partitioned_write_splits_a_large_partition(spark, tmp_path):
    df = spark.range(0, 200000, 1, 8).select(F.xxhash64("id").alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).otherwise(7).alias("k"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        writes.write_partitioned(df, str(tmp_path / "t"), "k")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("k=*")}
    assert files["k=7"] == max(files.values()) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200000


def test_csv_quotes_all(spark, tmp_path):
    writes.write_csv(spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1), str(tmp_path / "c"), quote_all=True)
    assert "".join(p.read_text() for p in (tmp_path / "c").glob("*.csv")) == '"a","b"\n"1","x"\n'


def test_normalise_and_back(spark):
    df = spark.createDataFrame([(1, "Rubber Soul", ["a", "b"]), (2, "Let It Be", [])], "id int, album string, songs array<string>")
    parents, children = writes.normalise(df, "id", "songs", "song", ["album"])
    assert rows(parents) == [(1, "Rubber Soul"), (2, "Let It Be")]
    assert rows(writes.denormalise(parents, children, "id").select("album", "song")) == [("Rubber Soul", "a"), ("Rubber Soul", "b")]


def test_normalise_values(spark):
    df = spark.createDataFrame([(1, "Beatles"), (2, "Beatles"), (3, "Wood"), (4, None)], "album int, artist string")
    artists, albums = writes.normalise_values(df, "artist", "artist_id")
    assert sorted(r.artist_id for r in artists.collect()) == [1, 2] and albums.columns == ["album", "artist_id"]
    assert rows(albums.join(artists, "artist_id", "left").select("album", "artist")) == rows(df)


# Scheduled loads


@pytest.fixture(scope="module")
def trips(spark):
    data = [(1, ts("2018-01-31 23:59:59")), (2, ts("2018-02-01 00:00:00")), (3, ts("2018-02-28 10:00:00")), (4, ts("2018-03-01 00:00:00"))]
    return spark.createDataFrame(data, "trip_id int, start_time timestamp")


def test_month_load_replaces_its_month_only(spark, tmp_path, trips):
    path = str(tmp_path / "trips")
    for day in ("2018-01-01", "2018-02-14", "2018-02-14"):
        load_partition(trips, path, "start_time", day)
    assert rows(spark.read.parquet(path).select("trip_id", "month")) == [(1, 1), (2, 2), (3, 2)]


def test_backfill(spark, tmp_path, trips):
    path = str(tmp_path / "trips")
    for _ in range(2):
        backfill(trips, path, "start_time", dt.date(2018, 2, 10), dt.date(2018, 3, 1))
    assert rows(spark.read.parquet(path).select("trip_id")) == [(2,), (3,), (4,)]
    assert rows(run_months(spark, "2018-02-10", "2018-03-01")) == [(dt.date(2018, 2, 1),), (dt.date(2018, 3, 1),)]


def test_stream_takes_each_file_once(spark, tmp_path):
    incoming, root, checkpoint = (str(tmp_path / n) for n in ("in", "state", "progress"))
    schema = USERS + ", ts long"
    empty = spark.createDataFrame([], USERS)

    def arrive_and_run(rows_, expected_version):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").json(incoming)
        run()
        assert snapshots.newest(spark, root).number == expected_version

    def run():
        source = spark.readStream.schema(schema).json(incoming)
        upsert_stream(source, empty, root, checkpoint, ["user_id"], ["level"], ["ts"]).awaitTermination()

    arrive_and_run([("1", "Ann", "free", 1)], 0)
    arrive_and_run([("1", "Anna", "paid", 2), ("2", "Bob", "free", 2)], 1)
    run()  # nothing new
    assert rows(snapshots.read_state(spark, root)) == [("1", "Ann", "paid"), ("2", "Bob", "free")]
    assert snapshots.newest(spark, root).number == 1


def test_stream_repeats_a_batch_that_did_not_commit(spark, tmp_path):
    incoming, root, checkpoint = (str(tmp_path / n) for n in ("in", "state", "progress"))
    schema = USERS + ", ts long"
    empty = spark.createDataFrame([], USERS)

    def run():
        source = spark.readStream.schema(schema).json(incoming)
        upsert_stream(source, empty, root, checkpoint, ["user_id"], ["level"], ["ts"]).awaitTermination()

    for row in (("1", "Ann", "free", 1), ("1", "Ann", "paid", 2)):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(incoming)
        run()
    # As after a failure between the write of the state and its commit.
    (tmp_path / "progress/commits/1").unlink()
    (tmp_path / "progress/commits/.1.crc").unlink(missing_ok=True)
    run()
    assert snapshots.newest(spark, root).number == 1
    assert rows(snapshots.read_state(spark, root)) == [("1", "Ann", "paid")]


def test_stream_with_a_new_checkpoint_goes_on_from_the_newest_version(spark, tmp_path):
    incoming, root = (str(tmp_path / n) for n in ("in", "state"))
    schema = USERS + ", ts long"
    empty = spark.createDataFrame([], USERS)

    def arrive_and_run(row, checkpoint):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(incoming)
        source = spark.readStream.schema(schema).json(incoming)
        progress = str(tmp_path / checkpoint)
        upsert_stream(source, empty, root, progress, ["user_id"], ["level"], ["ts"]).awaitTermination()

    arrive_and_run(("1", "Ann", "free", 1), "first")
    arrive_and_run(("2", "Bob", "free", 2), "first")
    arrive_and_run(("3", "Cy", "free", 3), "second")
    newest = snapshots.read_state(spark, root)
    assert [r[0] for r in rows(newest.select("user_id"))] == ["1", "2", "3"]


def test_stage_and_check(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,city\n1,X\n")
    (tmp_path / "e.csv").write_text("id,city\n")
    assert bikes.stage_and_check(spark, str(tmp_path / "s.csv"), "id int, city string", str(tmp_path / "s")).count() == 1
    with pytest.raises(DataQualityError):
        bikes.stage_and_check(spark, str(tmp_path / "e.csv"), "id int, city string", str(tmp_path / "e"))


# Layouts


def test_bucketed_join_has_no_shuffle(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = layout.write_bucketed(df, "bucket_a", 4, "k")
    b = layout.write_bucketed(df.withColumn("v", F.col("k")), "bucket_b", 4, "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert layout.shuffle_count(a.join(b, "k")) == 0
        assert layout.shuffle_count(df.join(b.select("k"), "k")) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sorted_layout(spark, tmp_path):
    layout.write_sorted(spark.range(100).select((F.col("id") * 37 % 100).alias("v")), str(tmp_path / "s"), "v")
    files_ = spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name().alias("f")).agg(F.min("v").alias("a"), F.max("v").alias("b"))
    spans = sorted((r.a, r.b) for r in files_.collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_work_folder_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    assert root is None or folder.startswith(root)


def test_work_folder_needs_a_shared_folder_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return default

        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(ValueError):
        work_folder(Session, "x")
    Session.sparkContext.master = "local[2]"
    assert "/x-" in work_folder(Session, "x")
