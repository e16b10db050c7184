"""Code search against sorting all distances."""

import random

import numpy as np
from hypothesis import given, settings, strategies as st

from starloom.llm import hamming

VECTOR = "id long, vector array<float>"


def brute(rows, queries, k):
    out = []
    coded = [(i, v) for i, v in rows if i is not None and hamming.sign_code(v)]
    for q, v in queries:
        if q is None or not hamming.sign_code(v):
            continue
        near = sorted((sum((a >= 0) != (b >= 0) for a, b in zip(v, w)), i) for i, w in coded if len(w) == len(v))
        out += [(q, i, d, n + 1) for n, (d, i) in enumerate(near[:k])]
    return sorted(out)


def check(spark, rows, queries, k=5, **how):
    frames = [spark.createDataFrame(x, VECTOR) for x in (rows, queries)]
    got = hamming.nearest_codes(*frames, k=k, **how).select("query_id", "id", "distance", "rank")
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, queries, k)


def vectors(n, bits, seed=0):
    draw = random.Random(seed)
    return [(i, [draw.uniform(-1, 1) for _ in range(bits)]) for i in range(n)]


def test_blocks_and_lengths(spark):
    rows = vectors(300, 64) + [(1000 + i, v) for i, v in vectors(60, 20, 1)] + [(2000, [1.0])]
    check(spark, rows, rows[::20], block_rows=70)
    frames = [spark.createDataFrame(x, VECTOR) for x in (rows, rows[:2] * 3)]
    assert hamming.nearest_codes(*frames, k=4).count() == 8


def test_ties_copies_and_odd_rows(spark):
    one = [1.0] * 32
    rows = [(i, one) for i in range(50, 0, -1)] + [(60 + i, [-1.0] * i + one[i:]) for i in range(33)]
    rows += [(200, None), (201, []), (None, one), (202, [float("nan")] * 32), (7, one), (300, [None] + one[1:])]
    check(spark, rows, [(1, one), (2, [-1.0] * 32), (200, None), (None, one), (3, [])], k=4)


def test_few_rows_and_empty_tables(spark):
    rows = vectors(3, 48)
    check(spark, rows, rows[:1], k=10)
    check(spark, [], rows)
    check(spark, rows, [])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.sampled_from([16, 32, 64]), st.integers(1, 12), st.integers(0, 10**6))
def test_index_is_exact(n, bits, k, seed):
    draw = np.random.default_rng(seed)
    codes = sorted({draw.integers(0, 2 ** int(draw.integers(1, 17)), bits // 16).astype(np.uint16).tobytes() for _ in range(n)})
    index = hamming.CodeIndex(codes, [[i, i + 1000] for i in range(len(codes))])
    for code in codes[:3] + [draw.bytes(bits // 8)]:
        query = np.frombuffer(code, np.uint8)
        far = [int(np.bitwise_count(np.frombuffer(c, np.uint8) ^ query).sum()) for c in codes]
        expected = sorted((d, i + more) for i, d in enumerate(far) for more in (0, 1000))[:k]
        assert index.nearest(code, k) == expected
