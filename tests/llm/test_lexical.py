"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import lexical
from starloom.llm.queries import op12_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, queries, k=20):
    held = [(i, Counter(split(t))) for i, t in documents]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for q, text in set(queries):
        scores = []
        for i, c in held:
            m = 75 + (25 * sum(c.values()) * n_docs) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in Counter(split(text)).items()
                if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(q, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda r: (r[0], r[1], r[2] or 0))[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "doc_id", "score").collect()), key=repr)


def search(spark, documents, queries, change=lambda df: df, **options):
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(queries, "query_id long, text string")
    return lexical.best_documents(change(docs), change(asked), **options)


def prose(n, words=40, vocabulary=60, seed=1):
    random.seed(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(random.choices(names, weights, k=random.randint(1, words)))) for i in range(n)]


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_terms(text):
    assert [t.decode() for t in lexical.terms(text)] == split(text)


@pytest.mark.parametrize("block", [1, 500, 10**9])
def test_equals_scoring_all(spark, block):
    documents, queries = prose(400), prose(25, 12, seed=2)
    assert found(search(spark, documents, queries, k=5, block_entries=block)) == brute(documents, queries, 5)


def test_several_sets_of_queries(spark):
    documents, queries = prose(120), prose(25, 12, seed=3)
    assert found(search(spark, documents, queries, k=7, query_entries=60)) == brute(documents, queries, 7)


def test_ties_nulls_repeats_and_long_texts(spark):
    documents = [(i, "same words here") for i in range(40, 0, -1)]
    documents += [(None, "same words here"), (None, None), (90, None), (91, ""), (92, " .,- "), (93, "ÉÈ é x\x00y A-b"), (93, "ÉÈ é x\x00y A-b")]
    documents += [(94, "same " * 200_000), (95, "Ünïcode ünïcode"), (None, "rare")]
    queries = [(1, "Same same HERE"), (2, "é y unknown"), (3, ""), (4, None), (5, "nothing of it"), (6, "rare a"), (1, "Same same HERE"), (7, "x" * 100_000)]
    assert found(search(spark, documents, queries)) == brute(documents, [q for q in queries if q[1]])


def test_empty_tables(spark):
    assert found(search(spark, [], [(1, "a")])) == []
    assert found(search(spark, [(1, "a")], [])) == []
    assert found(search(spark, [(1, None)], [(1, "a")])) == []


def test_clashing_columns(spark):
    names = ["query", "n", "terms", "counts", "term", "count", "score", "rank", "number"]
    documents, queries = prose(50), prose(5, 6, seed=4)
    got = search(spark, documents, queries, lambda df: df.withColumns({c: F.lit("x") for c in names}))
    assert found(got) == brute(documents, queries)


def lists(rows):
    """Impact lists of ``document -> {term: impact}``."""
    entries = [(d, t, i) for d, row in enumerate(rows) for t, i in sorted(row.items())]
    return lexical.ImpactLists(len(rows), *(np.array(c, np.int64) for c in zip(*entries)))


def asked(*terms):
    return np.array(terms, np.int64), np.ones(len(terms), np.int64)


@pytest.mark.parametrize("seed", range(30))
def test_block_search(seed, monkeypatch):
    monkeypatch.setattr(lexical, "_RUN", 1)
    random.seed(seed)
    rows = [{t: random.randint(1, 9) for t in random.sample(range(6), random.randint(1, 6))} for _ in range(60)]
    terms = random.sample(range(8), 4)
    documents, scores, _ = lists(rows).search(asked(*terms), 5, 0)
    every = sorted(((-sum(r.get(t, 0) for t in terms), d) for d, r in enumerate(rows)))
    best = sorted(zip((-scores).tolist(), documents.tolist()))[:5]
    assert best == [e for e in every if e[0] < 0][:5]


def test_the_search_stops_at_best_positions_before_last_read_ones(monkeypatch):
    """Direct accesses move the best position beyond what was read, so the threshold falls sooner."""
    monkeypatch.setattr(lexical, "_RUN", 1)
    monkeypatch.setattr(lexical, "_LONGEST_RUN", 1)
    # Documents 0 to 9 lead both lists, in opposite orders; then impacts fall.
    rows = [{0: 100 - d, 1: 91 + d} for d in range(10)] + [{0: 5, 1: 5} for _ in range(500)]
    block = lists(rows)
    documents, _, read = block.search(asked(0, 1), 3, 0)
    assert set(documents.tolist()) >= {0, 1, 2}
    # After five runs all ten leaders have been accessed, so both best positions are 10; last-read positions are 5.
    assert read == 2 * 5 or read == 2 * 6


def test_equal_scores_are_not_cut_off(monkeypatch):
    """The end needs a threshold strictly below the k-th score: a document with an equal score may have a smaller id."""
    monkeypatch.setattr(lexical, "_RUN", 1)
    documents, scores, read = lists([{0: 7} for _ in range(50)]).search(asked(0), 3, 0)
    assert len(documents) == 50 and read == 50 and set(scores.tolist()) == {7}


def test_a_known_kth_score_ends_the_search_at_once(monkeypatch):
    monkeypatch.setattr(lexical, "_RUN", 1)
    _, _, read = lists([{0: 50 - d} for d in range(50)]).search(asked(0), 3, 60)
    assert read == 1


def test_most_positions_are_not_read(spark):
    """Selective terms next to a frequent one: the frequent list is left early."""
    rows = [{0: 1000 - d % 7, **({1: 50_000} if d % 100 == 0 else {})} for d in range(20_000)]
    _, _, read = lists(rows).search(asked(0, 1), 20, 0)
    assert read < 2_000


def test_the_query(spark):
    table = lambda n, c: [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet").select(c, "text").collect()]
    got = op12_lexical_search(spark, "/root/testdata/sf0.001").withColumnRenamed("item_id", "query_id")
    assert found(got) == brute(table("documents", "doc_id"), table("benchmark", "item_id"))
