"""Packing against an exhaustive choice of boundaries and the definition of batches."""

import itertools
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starloom.llm import packing, queries
from tests.llm.conftest import split


def padding(histogram, bounds):
    return sum(c * (min(b for b in bounds if b >= v) - v) for v, c in histogram.items())


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), min_size=1, max_size=8), st.integers(1, 4))
def test_boundaries_are_optimal(histogram, buckets):
    got = packing.best_boundaries(histogram, buckets)
    lengths = sorted(histogram)
    choices = (
        [*c, lengths[-1]] for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], k)
    )
    assert len(got) <= buckets and got[-1] == lengths[-1] and got == sorted(got)
    assert padding(histogram, got) == min(padding(histogram, c) for c in choices)


def check(rows, lengths, max_length, budget):
    """``rows``: the packed pieces; ``lengths``: tokens of each document."""
    pieces = Counter()
    for i, n in lengths:
        for p in range(max(1, -(-n // max_length))):
            pieces[(i, p, p * max_length, min(max_length, n - p * max_length))] += 1
    assert Counter((r.doc_id, r.piece, r.first_token, r.n_tokens) for r in rows) == pieces
    batches = defaultdict(list)
    for r in rows:
        assert (r.bucket is None) == (r.batch is None) == (r.n_tokens == 0)
        if r.bucket:
            batches[r.bucket].append(r.batch)
    bounds = sorted(batches)
    for r in rows:
        if r.bucket:
            assert r.bucket == min(b for b in bounds if b >= r.n_tokens)
    for b, numbers in batches.items():
        most = max(1, budget // b)
        sizes = Counter(numbers)
        last = max(sizes)
        assert all(sizes[k] == most for k in range(last)) and 0 < sizes[last] <= most


@pytest.mark.parametrize("shard", [7, 50_000])
def test_batches(documents, odd_columns, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_ROWS", shard)
    draw = random.Random(3)
    pairs = [(i, "w " * int(draw.paretovariate(0.7))) for i in range(200)]
    pairs += [(900, None), (901, ""), (902, " \n\t"), (903, "x\x0by"), (1, pairs[1][1]), (None, "a b"), (904, "w " * 100_000)]
    df = odd_columns(documents(pairs))
    rows = packing.pack(df, packing.word_tokens(F.col("text")), max_length=50, buckets=5, budget=300).collect()
    check(rows, [(i, len(split(t))) for i, t in pairs], 50, 300)


def test_rows_without_id_fill_many_shards(spark, documents, monkeypatch):
    """Rows that repeat an id, or have none, are numbered in different shards."""
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    df = documents([(None if i % 2 else 7, "a b c") for i in range(2_000)])
    seen = []
    real = packing.F.pmod
    monkeypatch.setattr(packing.F, "pmod", lambda a, b: seen.append(real(a, b)) or seen[-1])
    packed = packing.pack(df, packing.word_tokens(F.col("text")), budget=30)
    check(packed.collect(), [(None if i % 2 else 7, 3) for i in range(2_000)], packing.MAX_LENGTH, 30)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(row#" in plan and "xxhash64(doc_id#" not in plan and len(seen) == 1


def test_lengths_are_counted_once(documents):
    packed = packing.pack(documents([(1, "a b")]), packing.word_tokens(F.col("text")))
    assert "regexp" not in packed._jdf.queryExecution().optimizedPlan().toString().lower()


def test_empty_tables(documents):
    assert packing.pack(documents([]), packing.word_tokens(F.col("text"))).count() == 0
    rows = packing.pack(documents([(1, None), (2, "")]), packing.word_tokens(F.col("text"))).collect()
    assert [(r.n_tokens, r.bucket) for r in rows] == [(0, None)] * 2


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    lengths = [(r.doc_id, len(split(r.text))) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = queries.op4_packing(spark, folder).collect()
    check(rows, lengths, packing.MAX_LENGTH, packing.BUDGET)
    histogram = Counter(r.n_tokens for r in rows if r.n_tokens)
    assert sorted({r.bucket for r in rows if r.bucket}) == packing.best_boundaries(histogram)
