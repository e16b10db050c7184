"""Incremental ingest of new files into a keyed table."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.keyed_state import fold
from starloom.operators.snapshots import newest
from starloom.operators.upsert import upsert


def _first_state(spark: SparkSession, root: str, checkpoint: str) -> int:
    """Number of batch 0's state; kept with the checkpoint, so that both are lost together."""
    path = f"{checkpoint.rstrip('/')}/first_version"
    try:
        return spark.read.parquet(path).first()[0]
    except AnalysisException:
        state = newest(spark, root)
        number = state.number + 1 if state else 0
        spark.range(number, number + 1, 1, 1).write.mode("overwrite").parquet(path)
        return number


def upsert_stream(
    source: DataFrame, empty: DataFrame, root, checkpoint, keys, update_cols, order_by, buckets=64
) -> StreamingQuery:
    """Fold the files that arrived since the last run into a keyed table, then stop.

    A batch rewrites only the buckets that hold its keys. A checkpoint numbers
    its states from the first one that was free when it was new; batch ``n``
    starts from the newest state below its own and publishes its own. The
    checkpoint hands every file to exactly one batch, and a batch that is repeated
    after a failure finds or publishes the same state. After the loss of a
    checkpoint the files are folded in once more, into newer states.
    """
    first = _first_state(source.sparkSession, root, checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge = lambda rows, new: upsert(rows, new, keys, update_cols, order_by)
        fold(root, first + batch_id, batch, empty, keys, merge, buckets)

    return (
        source.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
