"""Outlier rules: counts against brute force, estimate and verdicts against a direct computation."""

import math
import random

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starloom.llm import outliers
from tests.llm.conftest import split


def brute(text):
    words = split(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é|#\n\t\x0b", max_size=60))
def test_counts(text):
    assert outliers.base_statistics(text) == brute(text)


def test_counts_of_edge_cases():
    assert outliers.base_statistics(None) == outliers.base_statistics("") == (0,) * 6
    assert outliers.base_statistics("a a a a")[4] == 4
    assert outliers.base_statistics("a b c " * 50_000)[:1] == (150_000,)
    many = " ".join(f"w{i}" for i in range(2**20 + 5)) + " w1 w2 w3"
    assert outliers.base_statistics(many)[4] == 6


def prose(seed, n=120):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 9))) for _ in range(n))


def table(documents, n=160):
    good = [(i, prose(i)) for i in range(n)]
    bad = [(1000 + i, " ".join(w + "***" for w in prose(i).split())) for i in range(6)]
    return documents(good + bad + [(2000, None), (2001, ""), (2002, "few words"), (0, prose(0)), (None, prose(3))])


def test_outliers_go_and_clean_texts_stay(documents):
    rows = {r.doc_id: r for r in outliers.quality_rules(table(documents)).collect()}
    assert all(rows[i].kept for i in range(160)) and rows[None].kept
    assert not any(rows[1000 + i].kept or rows[1000 + i].base_failed for i in range(6))
    assert all(rows[i].base_failed and not rows[i].kept for i in (2000, 2001, 2002))


def test_a_text_that_only_repeats_lines_or_words_goes(documents):
    draw = random.Random(7)
    names = prose(500, 40).split()
    lines = "\n".join(names + draw.choices(names, k=760))
    words = (prose(501, 102) + " ") + " ".join(prose(502, 5).split() * 20)
    counts = [outliers.base_statistics(t) for t in (lines, words)]
    assert counts[0][3] * 100 >= 94 * counts[0][5] and counts[0][4] * 20 <= counts[0][0]
    assert counts[1][3] == 0 and 48 * counts[1][0] <= 100 * counts[1][4] <= 50 * counts[1][0]
    rows = {r.doc_id: r for r in outliers.quality_rules(documents([(i, prose(i)) for i in range(160)] + [(1000, lines), (1001, words)])).collect()}
    assert all(rows[i].kept for i in range(160))
    assert not any(rows[i].kept or rows[i].base_failed for i in (1000, 1001))


def direct(x, noise):
    """Reweighted estimate of one group, in memory: three starts, two steps each, the best until its determinant stops falling."""
    total, p = x.shape
    noise = noise.mean(0)
    quarter = lambda q: np.quantile(x, q, 0, method="inverted_cdf")
    scale, middle = np.maximum((quarter(0.75) - quarter(0.25)) / 1.349, np.sqrt(noise)), quarter(0.5)
    z = (x - middle) / scale
    sign, squashed = z / np.sqrt((z * z).sum(1, keepdims=True) + 1e-12), np.tanh(z)
    shapes = [np.eye(p), sign.T @ sign / total, squashed.T @ squashed / total]

    def near(centre, precision):
        off = x - centre
        return np.maximum(((off @ precision) * off).sum(1), 0)

    def solve(core, factor):
        centre = x[core].mean(0)
        scatter = np.cov(x[core].T, bias=True).reshape(p, p) * factor
        return centre, scatter, np.linalg.inv(scatter + np.diag(noise)), np.linalg.slogdet(scatter + np.diag(noise))[1]

    def step(centre, precision):
        ring = np.floor(np.log(near(centre, precision) + 1e-9) * outliers._RINGS)
        core = ring <= np.sort(ring)[min(total, (total + p + 1) // 2) - 1]
        return solve(core, outliers.core_factor(core.sum() / total))

    tried = []
    for scatter in outliers.first_scatters(scale, shapes):
        found = step(middle, np.linalg.inv(scatter + np.diag(noise)))
        tried.append(step(found[0], found[2]))
    best = min(tried, key=lambda f: f[3])
    while (found := step(best[0], best[2]))[3] < best[3] - 1e-6:
        best = found
    inside = near(best[0], best[2]) <= outliers._chi_square_quantile(0.975, p)
    return (*solve(inside, outliers._consistency(0.975))[:2], total)


def verdicts(texts):
    """``kept`` and distance of ``(key, text)`` rows by the direct estimate."""
    counts = np.array([brute(t) for _, t in texts], float).reshape(len(texts), 6)
    n, lines = np.maximum(counts[:, 0], 1), np.maximum(counts[:, 5], 1)
    x = np.rint(1000 * np.stack((np.log(np.maximum(counts[:, 1], 1) / n), np.sqrt(counts[:, 2] / n), np.sqrt(counts[:, 3] / lines), np.sqrt(counts[:, 4] / n)), 1))
    noise = np.rint(outliers.CLUMPS * 250_000 / np.stack((n, n, lines, n), 1))
    ok = (counts[:, 0] >= 50) & (100 * counts[:, 4] <= 50 * counts[:, 0])
    pool = direct(x[ok], noise[ok])
    limit = math.sqrt(outliers._chi_square_quantile(outliers.CUTOFF, 4))
    far = np.full(len(texts), np.nan)
    for key in {k for k, _ in texts}:
        rows = np.array([k == key for k, _ in texts]) & ok
        if rows.any():
            own = direct(x[rows], noise[rows])
            centre, scatter = outliers.shrunk(own[:2], pool[:2], own[2])
            for i in np.flatnonzero(rows):
                off = x[i] - centre
                far[i] = np.sqrt(max(0, off @ np.linalg.inv(scatter + np.diag(noise[i])) @ off))
    return ok & ~(far > limit), far


def compare(df):
    """The operator against the direct estimate, row by row; returns the kept ids."""
    rows = df.select("doc_id", "lang", "source", "text").collect()
    kept, far = verdicts([((r.lang or "", r.source or ""), r.text) for r in rows])
    got = sorted(((r.doc_id, r.kept, r.distance) for r in outliers.quality_rules(df).collect()), key=repr)
    expected = sorted(((r.doc_id, bool(k), None if np.isnan(d) else d) for r, k, d in zip(rows, kept, far)), key=repr)
    assert [(g[0], g[1]) for g in got] == [(e[0], e[1]) for e in expected]
    assert np.allclose([g[2] or 0 for g in got], [e[2] or 0 for e in expected], rtol=1e-6)
    return {r[0] for r in got if r[1]}


def test_query_equals_the_direct_estimate(spark):
    compare(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_groups_of_all_sizes(documents):
    df = table(documents).withColumn("source", F.when(F.col("doc_id") % 50 > 0, F.concat(F.lit("s"), F.floor(F.sqrt(F.col("doc_id") % 50)))))
    compare(df.repartition(4))


def test_a_group_with_forty_percent_bad_rows(documents):
    """More than a quarter of a group, from its own and from the general estimate."""
    draw = random.Random(3)

    def junk(i):
        return " ".join(w + "##" if draw.random() < 0.25 else w for w in prose(i).split())

    pairs = [(i, prose(i)) for i in range(72)] + [(1000 + i, junk(i)) for i in range(48)]
    assert compare(documents(pairs)) == set(range(72))


def test_verdicts_are_not_fixed_thresholds(documents):
    """The same texts are usual in a source of tables and outliers among prose."""
    def cells(i):
        return " ".join(w + "|" if k % 4 == 0 else w for k, w in enumerate(prose(i).split()))

    df = documents([(i, prose(i)) for i in range(150)] + [(1000 + i, cells(i)) for i in range(3)] + [(2000 + i, cells(i)) for i in range(400)])
    df = df.withColumn("source", F.when(F.col("doc_id") >= 2000, "tables").otherwise("prose"))
    kept = compare(df)
    assert {i for i in kept if i < 2000} == set(range(150)) and {i for i in kept if i >= 2000} == set(range(2000, 2400))


def test_verdicts_hardly_depend_on_the_size_of_the_input(documents):
    """A clear outlier goes in a table of 10, 90 and 900 rows alike."""
    bad = " ".join(w + "***" for w in prose(77).split())
    for n in (10, 90, 900):
        assert compare(documents([(i, prose(i)) for i in range(n)] + [(5000, bad)])) == set(range(n))


def test_small_groups_share_one_estimate_and_the_stage_keeps_columns(documents, odd_columns):
    df = odd_columns(table(documents)).withColumn("lang", F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("l"), F.col("doc_id") % 4)))
    kept = outliers.keep_good(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=lambda v: (v is None, v)) == sorted([0, *range(160)]) + [None]


def test_empty_table_and_too_few_rows(documents):
    assert outliers.quality_rules(documents([])).count() == 0
    assert compare(documents([(1, prose(1)), (2, prose(2) + " ###")])) == {1, 2}
    assert compare(documents([(1, prose(1))])) == {1}
    assert outliers.quality_rules(documents([(1, "few words"), (2, None)])).where("kept").count() == 0


def test_the_stage_counts_each_text_once_and_filters_by_a_column(documents):
    plan = outliers.keep_good(table(documents))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    # Written out in the filter, the distance is thousands of lines of code that no compiler takes.
    assert all("SQRT" not in line for line in plan.split("\n") if line.lstrip(" +-:*()0123456789").startswith("Filter"))
