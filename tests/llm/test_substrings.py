"""Substring dedup against a direct count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starloom.llm import queries, substrings
from starloom.llm.words import WordHasher
from tests.llm.conftest import split

FOLDER = "/root/testdata/sf0.001"


def brute(texts, window=35):
    words = [split(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    expected = sorted(((i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows]))), key=repr)
    assert sorted((tuple(r) for r in substrings.substring_digests(df).collect()), key=repr) == expected


def test_query_equals_brute_force(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    expected = {i: b for (i, _), b in zip(rows, brute([t for _, t in rows]))}
    got = {r[0]: tuple(r)[1:] for r in queries.op3_substring_dedup(spark, FOLDER).collect()}
    assert got == expected and sum(v[1] for v in got.values()) > 0


def test_shared_passages_and_edge_cases(documents, odd_columns):
    draw = random.Random(5)
    words = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    passage, long = words(60), words(9000)
    pairs = [(i, f"{words(draw.randrange(50))} {passage} {words(draw.randrange(50))}") for i in range(40)]
    pairs += [(100, passage.split(" ", 10)[-1]), (101, " ".join(passage.split()[:35])), (102, " ".join(passage.split()[:34]))]
    pairs += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "z " * 300), (205, "z " * 36)]
    pairs += [(300, long), (301, long[:20000] + "\n" + words(40)), (302, words(5) + "\x0b" + long[3000:])]
    pairs += [(400, words(80))] * 2 + [(None, passage), (None, None), (500, passage.upper())]
    df = documents(pairs)
    check(odd_columns(df))
    kept = substrings.drop_repeated(odd_columns(df))
    assert kept.columns == odd_columns(df).columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[200] is None and texts[202] == " \n" and texts[204] == "" and texts[102] == pairs[42][1]


def test_factors_are_copies_of_their_references(documents):
    """The words of a factor are those of its reference, and the next block is no copy that follows there."""
    draw = random.Random(11)
    words = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    passages = [words(n) for n in (40, 90, 300, 1500)]
    texts = [f"{words(draw.randrange(30))} {' '.join(draw.sample(passages, 3))} {words(draw.randrange(60))}" for _ in range(30)]
    texts += [passages[3] + " " + passages[3], passages[2].split(" ", 50)[-1]]
    named = {i: split(t) for i, t in enumerate(texts)}
    rows = substrings.parse(documents(list(enumerate(texts))), ["doc_id"]).select("row.columns.doc_id", "spans", "factors").collect()
    assert sum(len(r.factors) for r in rows) > 60
    for r in rows:
        mine, last = named[r.doc_id], 0
        for f in r.factors:
            size = f.end - f.first
            assert size >= 35 and mine[f.first : f.end] == named[f.doc][f.doc_first : f.doc_first + size]
            assert (f.doc, f.doc_first) != (r.doc_id, f.first)
            assert any(s.first <= f.first and f.end <= s.end for s in r.spans)
            assert f.first >= last  # Greedy from left to right: factors start one after another.
            last = f.first
    # A whole passage that stands in one place elsewhere is one factor, but for its first and last block.
    whole = next(r for r in rows if r.doc_id == 30)
    assert max(f.end - f.first for f in whole.factors) > 1000


def test_greedy_parse():
    a, b = ("a",), ("b",)
    copies = [(0, [(a, 5), (b, 0)]), (1, [(b, 1), (a, 9)]), (2, [(b, 2), (b, 7)]), (3, [(a, 1), (b, 8)]), (6, [(a, 2), (a, 2)])]
    assert substrings.factors(copies) == [(0, 3, (b, 0)), (3, 1, (a, 1)), (6, 1, (a, 2))]
    assert substrings.factors([]) == []


def test_columns_of_any_name(documents):
    names = ["_", "none", "columns", "row", "k1", "k2", "doc", "block", "first", "copies", "checked", "low", "high", "n", "spans", "factors", "kept"]
    df = documents([(i, " ".join(f"w{k}" for k in range(60)) + f" {i}") for i in range(5)]).withColumns({c: F.lit(c) for c in names})
    kept = substrings.drop_repeated(df)
    assert kept.columns == df.columns and all(r[c] == c for r in kept.collect() for c in names)


def test_a_hot_seed_is_split(spark, documents):
    """A passage in a third of all documents: the join with what was counted is one that Spark splits."""
    draw = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(40))
    pairs = [(i, (f"{passage} " if i % 3 == 0 else "") + " ".join(f"c{draw.random()}" for _ in range(45))) for i in range(3000)]
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    plans = []
    real = substrings._written

    def noted(df, folder, name):
        if name == "hits":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return real(df, folder, name)

    substrings._written = noted
    try:
        check(documents(pairs).repartition(8))
    finally:
        substrings._written = real
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "skew=true" in plans[0]


def test_empty_table(documents):
    assert substrings.substring_digests(documents([])).count() == 0


def test_very_common_passage_is_split_by_counts_only(documents):
    draw = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(36))
    check(documents([(i, f"a{i} {passage} b{draw.random()} " + " ".join(f"c{i}{k}" for k in range(30))) for i in range(300)]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=5, max_size=80))
def test_blocks_cover_all_windows_and_depend_on_content(words):
    hashes = WordHasher().hashes(words)
    first, seeds = substrings.cut_blocks(hashes, 5, 2)
    assert first[0] == 0 and (np.diff(first) > 0).all() and first[-1] <= len(words) - 5
    shifted, more = substrings.cut_blocks(WordHasher().hashes([b"x", b"y"] + words), 5, 2)
    owner = lambda f, s, n: np.repeat(s, np.diff(np.append(f, n)))
    n = len(words) - 4
    assert (owner(first, seeds, n) == owner(shifted, more, n + 2)[2:]).all()
