"""The registered queries of the operators, and the pipeline."""

import pytest

import __spark_entry__
import corpus_pipeline
from starloom.llm import load_all, outliers, quality
from starloom.session import read_table
from tests.llm.conftest import split
from tests.llm.test_jaccard import brute as near_copies
from tests.llm.test_packing import check as check_packing
from tests.llm.test_substrings import brute as repeated
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    problem, rows, _ = compare(spark, connect(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER)
    assert problem is None and rows > 0


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    docs = read_table(spark, FOLDER, "documents")
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = []
    for k, stage in enumerate(stages):
        out = stage(spark, docs, FOLDER)
        if k < len(stages) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append([r.asDict() for r in docs.collect()])
    whole = {r.doc_id: r.asDict() for r in read_table(spark, FOLDER, "documents").collect()}

    # Quality: the rows whose score is high enough, unchanged.
    labels = read_table(spark, FOLDER, "labels").where("crc32(cast(doc_id as string)) % 5 <> 0")
    model = quality.train(read_table(spark, FOLDER, "documents"), labels)
    scores = {i: model.score(quality.document_statistics(r["text"])[None])[0] for i, r in whole.items()}
    first = {r["doc_id"]: r for r in kept[0]}
    assert first == {i: r for i, r in whole.items() if scores[i] >= corpus_pipeline.LEAST_SCORE}

    # Rules: what fails the base rules goes, the others stay or are outliers.
    second = {r["doc_id"]: r for r in kept[1]}
    for i, r in first.items():
        n, *_, again, _ = outliers.base_statistics(r["text"])
        assert i not in second or (r == second[i] and n >= 50 and 100 * again <= 50 * n)
    verdicts = outliers.quality_rules(spark.read.parquet(f"{tmp_path}/0")).where("kept").collect()
    assert {r.doc_id for r in verdicts} == set(second)

    # Near copies: the smallest id of each class.
    classes = near_copies([(i, r["text"]) for i, r in second.items()], 80, 5)
    third = {r["doc_id"]: r for r in kept[2]}
    assert third == {i: second[i] for i, _, c in classes if i == c}

    # Passages, then packing.
    order = list(third)
    for i, (words, gone, _) in zip(order, repeated([third[i]["text"] for i in order])):
        row = next(r for r in kept[3] if r["doc_id"] == i)
        assert len(split(row["text"])) == words - gone and row["n_chars"] == len(row["text"])
        assert gone or row["text"] == third[i]["text"]
    packed = corpus_pipeline.run(spark, FOLDER)
    check_packing(packed.collect(), [(r["doc_id"], len(split(r["text"]))) for r in kept[3]], 2048, 65_536)
    assert packed.count() == len(kept[4])
