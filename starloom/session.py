"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs the next aggregate a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Columnar files grow when read; size estimates for broadcasts must know.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app="starloom", master=None, **settings) -> SparkSession:
    """A session with the settings the operators are tested with."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for written tables, under the cluster's shared folder.

    ``spark.checkpoint.dir`` names that folder. Only a local session without
    the setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="starloom-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
