"""Tables whose states are published in one step.

A state is a list of parts, folders of Parquet files below the table's folder.
A writer puts its rows into a new folder, where no reader looks, and then
publishes the new list as one small numbered file that is created exclusively.
Readers take the newest list that is whole. So a failure before the last step
leaves the old rows as they are, a frame may replace the very table it reads,
and of two writers that publish the same number one fails. Files are never
overwritten; what no list names any more is left to whoever owns the folder.
"""

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class StateExists(RuntimeError):
    """Another writer has published a state with this number."""


@dataclass(frozen=True)
class State:
    """A published state: its number, the folders of its parts by name, and what the writer noted."""

    number: int
    parts: dict
    notes: dict = field(default_factory=dict)


def _list_file(spark: SparkSession, root: str, name: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_states/{name}")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_list(spark, path, files) -> State | None:
    """The state in a file, or None if the file is not whole."""
    stream = files.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return State(**json.loads(text))
    except ValueError:
        return None


def newest(spark: SparkSession, root: str, before: int | None = None) -> State | None:
    """The newest published state, or the newest with a number below ``before``."""
    path, files = _list_file(spark, root, "*.json")
    found = {int(status.getPath().getName()[:-5]): status.getPath() for status in files.globStatus(path) or []}
    for number in sorted(found, reverse=True):
        if before is None or number < before:
            state = _read_list(spark, found[number], files)
            if state:
                return state
    return None


def publish(spark: SparkSession, root: str, number: int, parts: dict, **notes) -> State:
    """Make ``parts`` the state ``number``; raises ``StateExists`` if there is one."""
    state = State(number, parts, notes)
    path, files = _list_file(spark, root, f"{number:012d}.json")
    if files.exists(path) and _read_list(spark, path, files) is None:
        files.delete(path, False)  # What a writer that died left of its list.
    try:
        stream = files.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise StateExists(f"{root}: state {number}") from error
        raise
    stream.write(json.dumps(vars(state)).encode())
    stream.close()
    return state


def stage(df: DataFrame, root: str, *partition_by, options=None) -> str:
    """Write rows where no reader looks; returns the folder, relative to ``root``."""
    folder = f"data/{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.options(**(options or {})).partitionBy(*partition_by).parquet(f"{root.rstrip('/')}/{folder}")
    return folder


def replace_rows(df: DataFrame, root: str, options=None) -> State:
    """Publish ``df`` as the whole table."""
    return _load(df, root, {}, options)


def append_rows(df: DataFrame, root: str, options=None) -> State:
    """Publish the table's rows and those of ``df``."""
    state = newest(df.sparkSession, root)
    return _load(df, root, state.parts if state else {}, options)


def _load(df, root, kept, options):
    spark = df.sparkSession
    state = newest(spark, root)
    folder = stage(df, root, options=options)
    return publish(spark, root, state.number + 1 if state else 0, {**kept, folder: folder})


def read_state(spark: SparkSession, root: str, state: State | None = None, names=None) -> DataFrame | None:
    """The rows of a state (the newest), or of some of its parts; None where there are none."""
    state = state or newest(spark, root)
    parts = state.parts if state else {}
    folders = [parts[n] for n in (parts if names is None else names) if n in parts]
    return spark.read.parquet(*[f"{root.rstrip('/')}/{f}" for f in folders]) if folders else None
