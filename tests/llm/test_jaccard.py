"""Jaccard join against all pairs of small tables."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from starloom.llm import jaccard, queries
from tests.llm.conftest import split

FOLDER = "/root/testdata/sf0.001"


def shingles(text, size):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in split(text)]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, least=90, size=3):
    """Rows ``(doc_id, n_shingles, component_id)`` by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= least * (len(a) + len(sets[j]) - common):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for (i, _), s, g in zip(rows, sets, group):
        ids = [r[0] for r, h in zip(rows, group) if h == g and r[0] is not None]
        out.append((i, len(s), (min(ids) if ids else None) if s else i))
    return sorted(out, key=repr)


def check(df, **how):
    got = sorted((tuple(r) for r in jaccard.near_classes(df, **how).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], **how)
    return got


def families(draw, groups=12, copies=6, n=80):
    """Texts that are near copies of each other, with more and more words changed."""
    rows = []
    for g in range(groups):
        words = [f"g{g}w{draw.randrange(40)}" for _ in range(n)]
        for c in range(copies):
            if draw.random() < 0.6:
                words = words.copy()
                words[draw.randrange(n)] = f"x{draw.random()}"
            rows.append((100 * g + c, " ".join(words)))
    return rows


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op9_ngram_jaccard(spark, FOLDER).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize(("least", "size"), [(90, 3), (80, 5), (60, 2)])
def test_chains_of_near_copies(documents, least, size):
    got = check(documents(families(random.Random(least))), least=least, size=size)
    assert len({r[2] for r in got}) < len(got)


def test_edge_cases(documents, odd_columns):
    long = " ".join(f"l{i}" for i in range(20_000))
    pairs = [(5, "A B"), (3, "a b"), (4, "a"), (6, "A"), (7, "a b c"), (8, "c b a"), (9, "É b"), (10, "é b")]
    pairs += [(20, None), (21, ""), (22, " \t"), (23, None), (30, long), (31, long + " more"), (31, long + " more")]
    pairs += [(None, "a b c"), (None, "q r s t"), (None, None), (40, "q  r\ns\x0bt u"), (41, "q r s t u"), (42, "x y z " * 50)]
    df = odd_columns(documents(pairs))
    check(df)
    kept = jaccard.keep_first(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([3, 4, 7, 8, 9, 10, 20, 21, 22, 23, 30, None, None, 40, 42], key=repr)


def test_empty_table(documents):
    assert jaccard.near_classes(documents([])).count() == 0
    assert jaccard.keep_first(documents([])).count() == 0


def test_a_star_whose_ends_do_not_link(documents):
    """Copies of one text, each with its own changes, that link with the first text only."""
    draw = random.Random(1)
    words = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for c in range(1, 40):
        mine = words.copy()
        for i in draw.sample(range(0, 120, 4), 2 if c % 3 else 4):
            mine[i] = f"c{c}i{i}"
        rows.append((c, " ".join(mine)))
    check(documents(rows))


@pytest.mark.parametrize(("batch", "bucket"), [(1, 40), (200, 300), (10**9, 10**9)])
def test_signatures_meet_in_a_batch_or_in_their_bucket(documents, monkeypatch, batch, bucket):
    """Whatever the batches and buckets, and however often a bucket is settled."""
    monkeypatch.setattr(jaccard, "BATCH_SIGNATURES", batch)
    monkeypatch.setattr(jaccard, "BUCKET_SIGNATURES", bucket)
    check(documents(families(random.Random(2), 4, 5, 60)).repartition(3))


KINDS = {
    "whole": lambda h: jaccard.Plan(h + 1, 1, 0, 0),
    "subsets of one spare part": lambda h: jaccard.Plan(-(-(h + 1) // 2), 3, 1, 0),
    "subsets of three spare parts": lambda h: jaccard.Plan(-(-(h + 1) // 4), 6, 3, 0),
    "neighbourhoods": lambda h: jaccard.Plan(0, 1, 0, h // 2 + 1),
    "subsets and neighbourhoods": lambda h: jaccard.Plan(-(-max(0, h - 3) // 3), 4, 2, 2),
}


@pytest.mark.parametrize(("kind", "least", "size"), [(kind, *((90, 3), (80, 5))[i % 2]) for i, kind in enumerate(KINDS)])
def test_every_kind_of_segment_finds_all_links(documents, monkeypatch, kind, least, size):
    monkeypatch.setattr(jaccard, "allocate", lambda top, differences, sets: KINDS[kind](differences))
    check(documents(families(random.Random(5), 6, 8, 50)).repartition(2), least=least, size=size)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 10**6))
def test_sketches_never_part_linked_sets(size, changes, seed):
    random = np.random.default_rng(seed)
    one = np.unique(random.integers(0, 2**63, size, dtype=np.uint64))
    other = np.unique(np.concatenate((one[changes // 2 :], random.integers(0, 2**63, changes // 2, dtype=np.uint64))))
    a, b = (jaccard._counts([jaccard.sketch(s)]) for s in (one, other))
    for least in (90, 80, 60):
        may = jaccard._may_link(a, b, np.array([len(one)]), np.array([len(other)]), least)[0]
        assert may or not jaccard.linked(one, other, least)


def test_sketches_part_unrelated_sets():
    random = np.random.default_rng(1)
    for size in (30, 300, 2000):
        sets = [random.integers(0, 2**63, size, dtype=np.uint64) for _ in range(60)]
        counts = jaccard._counts([jaccard.sketch(s) for s in sets])
        assert not any(jaccard._may_link(counts[i], counts[j], size, size, 80) for i in range(60) for j in range(i))


@settings(max_examples=60, deadline=None)
@given(st.integers(1_500, 12_000), st.integers(0, 2_500), st.integers(0, 10**6))
def test_fine_sketches_never_part_linked_sets(size, changes, seed):
    random = np.random.default_rng(seed)
    one = np.unique(random.integers(0, 2**63, size, dtype=np.uint64))
    other = np.unique(np.concatenate((one[min(changes, size) // 2 :], random.integers(0, 2**63, changes, dtype=np.uint64))))
    a, b = jaccard.fine_sketch(one), jaccard.fine_sketch(other)
    for least in (90, 80, 60):
        assert jaccard._may_link_finely(a, b, len(one), len(other), least) or not jaccard.linked(one, other, least)


@pytest.mark.parametrize("size", [2_500, 9_000, 20_000])
def test_fine_sketches_part_long_unrelated_sets(size):
    """Also where the classes of the short sketches are so full that these no longer part them."""
    random = np.random.default_rng(2)
    sets = [random.integers(0, 2**63, round(size * part), dtype=np.uint64) for part in (0.9, 1, 1, 1.1)]
    pairs = [(a, b) for i, a in enumerate(sets) for b in sets[:i]]
    assert not any(jaccard._may_link_finely(*map(jaccard.fine_sketch, p), *map(len, p), 80) for p in pairs)


def test_only_sets_that_can_link_move_whole(documents, tmp_path, monkeypatch):
    """Unrelated long texts that meet by chance are told apart by their sketches: no set is made of them."""
    draw = random.Random(3)
    far = [(i, " ".join(f"f{draw.randrange(10**9)}" for _ in range(9_000)) + " the end") for i in range(3)]
    near = " ".join(f"n{draw.randrange(10**9)}" for _ in range(3_000))
    df = documents([*far, (10, near), (11, near + " more")])
    folder = str(tmp_path)
    # Signatures so coarse that all sets meet.
    monkeypatch.setattr(jaccard, "signatures", lambda shingles, scheme, plan: (np.array([1], np.uint64), np.zeros(1, bool)))
    found = jaccard.node_components(df, jaccard.describe(df, folder, 5), folder, 80, 5)
    assert len({r.component for r in found.collect()}) == 1 and found.count() == 2
    made = [df.sparkSession.read.parquet(f"{folder}/{name}") for name in ("sets", "sets_across")]
    assert sum(sets.count() for sets in made) <= 2


@pytest.mark.parametrize("parts", [1, 7, 100])
def test_keys_are_dealt_one_to_each_partition(spark, parts):
    keys = jaccard.even_keys(spark, parts)
    df = spark.createDataFrame([(k,) for k in keys], "bucket int").repartition(parts, "bucket")
    assert len(keys) == parts and df.rdd.glom().map(len).collect() == [1] * parts


def test_packed_holders():
    draw = np.random.default_rng(3)
    holders = np.empty(500, jaccard._HOLDER)
    holders["sig"] = draw.integers(0, 2**64, 500, np.uint64)
    holders["node"] = draw.choice(draw.integers(-(2**63), 2**63, 40), 500)
    holders["n"] = holders["node"] % 1000
    holders["deletion"] = draw.random(500) < 0.3
    got = jaccard._unpack(jaccard._pack(holders), 70_001)
    for c in ("node", "n", "deletion"):
        assert (got[c] == holders[c]).all()
    low = np.uint64(2**48 - 1)
    assert (got["sig"] & low == holders["sig"] & low).all() and (got["sig"] >> np.uint64(48) == 70_001 & 0xFFFF).all()


def test_packed_holders_name_a_set_once():
    """Each holder costs its six bytes of signature and a bit, a set in a row 16 bytes."""
    holders = np.zeros(8_000, jaccard._HOLDER)
    holders["node"], holders["n"] = np.repeat([5, -7, 9, 5], 2_000), np.repeat([50, 70, 90, 50], 2_000)
    holders["sig"], holders["deletion"] = np.arange(8_000), np.arange(8_000) % 3 == 0
    packed = jaccard._pack(holders)
    assert len(packed) == 8 + 4 * 16 + 8_000 * 6 + 1_000
    assert (jaccard._unpack(packed, 0) == holders).all()


def test_vectorised_shingles():
    """Sets of hashes are as large as the sets of shingles, equal texts have equal sets, and common shingles equal hashes."""
    texts = [None, "", " \t", "a", "A  a", "a b", "a b c", "c b a", "É b c d", "é b c d", "w " * 50, "x" * 3_000_000 + " a b", "ab c d", "a bc d"]
    texts += [" ".join(f"w{i * j % 7}" for i in range(40)) for j in range(5)]
    for size in (3, 5):
        sets = jaccard.shingle_sets([None if t is None else t.encode() for t in texts], size)
        assert [len(s) for s in sets] == [len(shingles(t, size)) for t in texts]
        alone = [jaccard.shingle_sets([(t or "").encode()], size)[0] for t in texts]
        assert all((a == b).all() for a, b in zip(sets, alone))
        for a, s in zip(sets, texts):
            for b, t in zip(sets, texts):
                assert len(np.intersect1d(a, b)) == len(shingles(s, size) & shingles(t, size))


def test_words_longer_than_a_chunk(monkeypatch):
    from starloom.llm import words

    monkeypatch.setattr(words, "_CHUNK", 16)
    monkeypatch.setattr(words, "_POWERS", [])
    texts = [b"a bb ccc", b"x" * 16 + b" y", b"z" * 17 + b" y " + b"x" * 16, b"q" * 40, b"A bb  CCC " + b"x" * 16]
    hashes, bounds = words.text_word_hashes(texts)
    named = [w for t in texts for w in t.lower().split()]
    assert len(hashes) == len(named) and np.diff(bounds).tolist() == [len(t.split()) for t in texts]
    assert len(set(zip(named, hashes.tolist()))) == len(set(named)) == len(set(hashes.tolist()))


def test_blocks_in_the_second_phase(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "_BLOCK", 3)
    monkeypatch.setattr(jaccard, "_CHUNK", 5)
    check(documents(families(random.Random(9), 6, 20, 60)))


def test_sets_that_meet_by_chance_stream_once_a_signature(spark, tmp_path):
    """Few rows are made of sets in many small signatures, and no link between components is lost."""
    draw, folder = random.Random(4), str(tmp_path)
    sets = [frozenset(draw.randrange(10**9) for _ in range(30)) for _ in range(180)]
    sets += [s | {1} for s in sets[:20]]
    groups = [draw.sample(range(200), 4) for _ in range(600)] + [[i, 180 + i, 100 + i] for i in range(20)]
    component = [i - i % 3 if i < 30 else i for i in range(200)]
    rows = [(sig, i, component[i]) for sig, group in enumerate(groups) for i in group]
    members = [(i, np.array(sorted(s), np.uint64).tobytes()) for i, s in enumerate(sets)]
    labelled = spark.createDataFrame(rows, "sig long, node long, component long")
    members = spark.createDataFrame(members, "node long, members binary")
    links = jaccard.across(labelled, members, lambda held: jaccard._Held(held, 90), folder).collect()
    wanted = {(component[i], component[180 + i]) for i in range(20)}
    assert {tuple(sorted((component[r.a], component[r.b]))) for r in links} == wanted
    assert spark.read.parquet(f"{folder}/stream").count() <= spark.read.parquet(f"{folder}/apart").count()


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 150), st.integers(0, 30), st.integers(0, 10**6), st.sampled_from([1, 10**9, 10**12, 10**15]))
def test_linked_sets_share_a_signature(size, changes, seed, sets):
    """Pigeonhole, for every allocation that the cost model picks, also with one-deletion neighbourhoods."""
    random = np.random.default_rng(seed)
    one = np.unique(random.integers(0, 2**63, size, dtype=np.uint64))
    other = np.unique(np.concatenate((one[min(changes, len(one) - 1) // 2 :], random.integers(0, 2**63, changes // 2, dtype=np.uint64))))
    for least in (90, 80):
        if not jaccard.linked(one, other, least):
            continue
        bands = jaccard.Bands(least)
        scheme = bands.of(max(len(one), len(other)))
        assert scheme in bands.schemes(len(one)) and scheme in bands.schemes(len(other))
        plan = jaccard.allocate(bands.top(scheme), bands.differences(scheme), sets)
        assert plan.absorbs() > bands.differences(scheme)
        for choice in (plan, *[kind(bands.differences(scheme)) for kind in KINDS.values()]):
            a, b = (dict(zip(*(x.tolist() for x in jaccard.signatures(s, scheme, choice)))) for s in (one, other))
            assert any(not (a[k] and b[k]) for k in a.keys() & b.keys())


def test_cost_model_takes_finer_signatures_for_larger_bands():
    few, many, most = (jaccard.allocate(200, 21, sets) for sets in (10, 10**8, 10**11))
    assert few == jaccard.Plan(22, 1, 0, 0) and many.spare > 0 and most.parts > many.parts
    assert jaccard.allocate(60, 12, 10**5).deleted > 0
    rows = [jaccard.expected_signatures(p, 200) for p in (few, many, most)]
    assert rows == sorted(rows)


def test_components(spark, tmp_path):
    draw = random.Random(4)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    group = list(range(400))
    for a, b in links:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        group = [new if g == old else g for g in group]
    got = jaccard.components(spark.createDataFrame(links, "a long, b long"), f"{tmp_path}/c").collect()
    there = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(tuple(r) for r in got) == sorted((x, group[x]) for x in there)
