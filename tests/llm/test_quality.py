"""Quality classifier: statistics, trees and held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import quality, queries


def test_statistics_cover_whole_texts():
    assert not quality.document_statistics(None).any() and not quality.document_statistics(" \n").any()
    short, long = quality.document_statistics("a b"), quality.document_statistics("a b" + " c!" * 200_000)
    assert long[list(quality._BYTE_CLASSES).index("exclaim")] > 0.3 and short.shape == (quality.N_FEATURES,)


def test_trees_equal_a_walk_node_by_node():
    random = np.random.default_rng(1)
    x = random.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit_trees(x, y, trees=12, depth=3, least_rows=5)

    def walk(row):
        total = model.base
        for t in range(len(model.feature)):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + 1 + (row[model.feature[t, node]] > model.threshold[t, node])
            total += model.value[t, node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(x), [walk(r) for r in x])
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def test_without_labels_the_score_is_constant(spark, documents):
    docs = documents([(1, "a b c"), (2, None), (3, "")])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert {r[0] for r in docs.select(quality.quality_score(F.col("text"), model)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None), (1, 1)], "doc_id long, quality int")
    assert 0.5 < quality.train(docs, one).score(np.zeros((1, quality.N_FEATURES)))[0] < 1


def test_empty_table_and_clashing_columns(spark, documents, odd_columns):
    model = quality.fit_trees(np.zeros((0, quality.N_FEATURES)), np.zeros(0))
    assert documents([]).select(quality.quality_score(F.col("text"), model)).count() == 0
    same = odd_columns(documents([(1, "x y"), (2, "x y")])).withColumn("mine", quality.quality_score(F.col("text"), model))
    assert len({r["mine"] for r in same.collect()}) == 1 and "score" in same.columns


@pytest.fixture(scope="module")
def scored(spark):
    return queries.op1_quality_classifier(spark, "/root/testdata/sf0.01").cache()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("quality", "predicted").collect()
    assert len(rows) > 50 and sum(a == b for a, b in rows) / len(rows) > 0.95


def test_every_document_has_a_score(spark, scored):
    import zlib

    rows = scored.collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
