"""Keyed tables kept up to date by batches: hash-partitioned state with a manifest.

The rows of a table lie in a fixed number of buckets by the hash of their key.
A batch is folded into the buckets its keys fall in; only these are read and
written anew, and the next published list names the new folder for them and the
old ones for all others. A state is numbered by its batch: one that is repeated
after a failure finds its number published and changes nothing, and one that
failed before is folded into the same state as the first time.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.operators import snapshots
from starloom.operators.snapshots import State

_BUCKET = "_bucket"


def bucket_of(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def fold(root: str, number: int, batch: DataFrame, empty: DataFrame, keys, merge, buckets=64) -> State:
    """Publish state ``number``: ``merge(rows, batch)`` in every bucket that has keys of the batch.

    ``empty`` has the columns of the table; the batch's keys take their types.
    ``merge`` gets the rows of the touched buckets and returns their next
    state; it must keep rows whose key is not in the batch. ``buckets`` counts
    for a new table only. Fetched is the list of touched buckets.
    """
    spark = batch.sparkSession
    state = snapshots.newest(spark, root, before=number + 1)
    if state and state.number == number:
        return state
    buckets = state.notes["buckets"] if state else buckets
    types = {f.name: f.dataType for f in empty.schema.fields}
    batch = batch.withColumns({k: F.col(k).cast(types[k]) for k in keys})
    touched = [str(r[0]) for r in batch.select(bucket_of(keys, buckets)).distinct().collect()]
    known = snapshots.read_state(spark, root, state, touched) if state else None
    return _publish(merge(empty if known is None else known, batch), root, number, state, touched, keys, buckets)


def _publish(rows, root, number, state, touched, keys, buckets):
    folder = snapshots.stage(rows.withColumn(_BUCKET, bucket_of(keys, buckets)), root, _BUCKET)
    written = _folders(rows.sparkSession, f"{root.rstrip('/')}/{folder}")
    parts = {b: f for b, f in (state.parts if state else {}).items() if b not in touched}
    parts |= {b: f"{folder}/{_BUCKET}={b}" for b in written}
    return snapshots.publish(rows.sparkSession, root, number, parts, buckets=buckets, keys=list(keys))


def _folders(spark, path):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return [n.split("=")[1] for n in names if n.startswith(f"{_BUCKET}=")]


def resize(spark: SparkSession, root: str, buckets: int) -> State:
    """Publish the same rows in another number of buckets."""
    state = snapshots.newest(spark, root)
    rows = snapshots.read_state(spark, root, state)
    return _publish(rows, root, state.number + 1, None, [], state.notes["keys"], buckets)


def read_key(spark: SparkSession, root: str, **key) -> DataFrame | None:
    """The row of one key; only its bucket is read. None where the bucket has no rows."""
    state = snapshots.newest(spark, root)
    any_part = snapshots.read_state(spark, root, state, list(state.parts)[:1])
    types = {f.name: f.dataType for f in any_part.schema.fields}
    values = [F.lit(key[k]).cast(types[k]) for k in state.notes["keys"]]
    bucket = spark.range(1).select(bucket_of(values, state.notes["buckets"])).first()[0]
    rows = snapshots.read_state(spark, root, state, [str(bucket)])
    if rows is None:
        return None
    for k, value in zip(state.notes["keys"], values):
        rows = rows.where(F.col(k).eqNullSafe(value))
    return rows
