"""Registered queries on tables where one key holds a third of the rows, with skew handling forced to act."""

import pytest
from pyspark.sql import functions as F

from starloom.slate import load_all
from tests.oracle import compare, connect

SOURCE = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}
# Tables that are not skewed here, or files of which there would be many.
LEFT_OUT = {"document_words", "repeated_lines", "label_lookup", "lake_star_tables", "immigration_tables"}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))

    def third(*salt):
        return F.pmod(F.xxhash64(*salt), F.lit(3)) == 0

    def hot(column, value, *salt):
        return F.when(third(*salt), F.lit(value).cast("long")).otherwise(F.col(column))

    changes = {
        "orders": {"o_custkey": hot("o_custkey", 7, "o_orderkey")},
        "lineitem": {
            "l_orderkey": hot("l_orderkey", 5, "l_orderkey", "l_partkey", "l_shipdate", F.lit(1)),
            "l_partkey": hot("l_partkey", 3, "l_partkey", "l_suppkey", "l_shipdate", F.lit(2)),
            "l_suppkey": hot("l_suppkey", 2, "l_extendedprice", F.lit(3)),
        },
        "events": {"user_id": hot("user_id", 9, "event_id")},
        "customer": {"c_nationkey": F.when(third("c_custkey"), 4).otherwise(F.col("c_nationkey"))},
    }
    names = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
    for name in names.split():
        df = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        df.withColumns(changes.get(name, {})).repartition(4).write.parquet(f"{folder}/{name}.parquet")
    old = {name: spark.conf.get(name) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield folder
    for name, value in old.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="module")
def con(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LEFT_OUT))
def test_query(spark, con, skewed, name):
    problem, _, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), skewed)
    assert problem is None
