"""Near vectors against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import lattice
from starloom.llm.queries import op13_lattice_dedup

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, least=0.95):
    """``vec_id, n_links, component_id, kept`` by comparing all pairs."""
    units = []
    for _, v in rows:
        usable = bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        u = np.array(v, np.float32).astype(float) if usable else None
        units.append(u / np.abs(u).max() / np.linalg.norm(u / np.abs(u).max()) if usable else None)
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and units[i] is not None and units[j] is not None
         and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least]
        for i in range(n)
    ]
    component = list(range(n))
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        component[i] = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
    return sorted(((rows[i][0], len(near[i]), component[i], rows[i][0] == component[i]) for i in range(n)), key=repr)


def found(spark, rows, change=lambda df: df, **options):
    df = change(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    return sorted((tuple(r) for r in lattice.near_vectors(df, **options).collect()), key=repr)


def close_to(rng, unit, cosine):
    """A vector at the given cosine."""
    side = rng.normal(size=len(unit))
    side -= side @ unit * unit
    return cosine * unit + math.sqrt(1 - cosine**2) * side / np.linalg.norm(side)


def unit(rng, size=64):
    v = rng.normal(size=size)
    return v / np.linalg.norm(v)


def test_neighbours():
    assert lattice.NEIGHBOURS.shape == (240, 8) and len(np.unique(lattice.NEIGHBOURS, axis=0)) == 240
    assert np.allclose((lattice.NEIGHBOURS**2).sum(1), 2) and np.allclose(lattice.decode(lattice.NEIGHBOURS), lattice.NEIGHBOURS)


def test_decoding_finds_the_nearest_point():
    """No neighbour of the point is nearer: the Voronoi cell of E8 is bounded by points of the first two shells."""
    rng = np.random.default_rng(1)
    y = rng.normal(scale=3, size=(2_000, 8))
    point = lattice.decode(y)
    twice = np.rint(2 * point)
    assert (twice == 2 * point).all() and ((twice % 2 == twice[:, :1] % 2).all(1)).all() and (point.sum(1) % 2 == 0).all()
    shells = np.unique((lattice.NEIGHBOURS[:, None] + lattice.NEIGHBOURS[None]).reshape(-1, 8), axis=0)
    shells = np.concatenate((lattice.NEIGHBOURS, shells))
    away = ((y - point) ** 2).sum(1)
    for shift in shells:
        assert (away <= ((y - point - shift) ** 2).sum(1) + 1e-9).all()
    assert away.max() <= 1 + 1e-9


def test_own_cell_and_neighbouring_cells():
    """The keys of a table are those of the own cell and of cells next to it, all different."""
    rng = np.random.default_rng(2)
    units = np.array([unit(rng) for _ in range(50)])
    tables = lattice.tables(64)
    keys = tables.cells(units).reshape(50, lattice.TABLES, lattice.CELLS)
    for t in range(lattice.TABLES):
        projected = units @ tables.project[t] + tables.shift[t]
        points = [lattice.decode(projected[:, 8 * j : 8 * j + 8]) for j in range(lattice.LATTICES)]
        with np.errstate(over="ignore"):
            own = sum(
                ((2 * p).astype(np.int64).astype(np.uint64) * tables.factors[t, j]).sum(1, dtype=np.uint64) for j, p in enumerate(points)
            )
            own = lattice.mix(own + tables.salt[t]).view(np.int64)
        assert all(own[i] in keys[i, t] for i in range(50))
        assert all(len(set(keys[i, t])) == lattice.CELLS for i in range(50))


@pytest.mark.parametrize("cosine, least", [(0.9501, 0.95), (0.98, 0.995)])
def test_recall_of_lone_pairs(cosine, least):
    rng = np.random.default_rng(3)
    first = np.array([unit(rng) for _ in range(1_500)])
    second = np.array([close_to(rng, u, cosine) for u in first])
    a, b = lattice.tables(64).cells(first), lattice.tables(64).cells(second)
    assert np.mean([bool(set(x) & set(y)) for x, y in zip(a.tolist(), b.tolist())]) >= least


def test_few_unrelated_vectors_share_a_cell():
    rng = np.random.default_rng(4)
    cells = lattice.tables(64).cells(np.array([unit(rng) for _ in range(2_000)]))
    _, counts = np.unique(cells, return_counts=True)
    assert (counts * (counts - 1) // 2).sum() < 5e-5 * 2_000**2 / 2


def families(seed, sizes, cosine, lone=40):
    rng = np.random.default_rng(seed)
    rows = [(i, unit(rng).tolist()) for i in range(lone)]
    for size in sizes:
        middle = unit(rng)
        rows += [(len(rows) + i, close_to(rng, middle, cosine).tolist()) for i in range(size)]
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize(("cosine", "block"), [(0.999, 8), (0.985, 8), (0.975, 2_048)])
def test_families(spark, cosine, block):
    """Tight families, those within the angle, and those in which only some pairs link; cut into rings and blocks or not."""
    rows = families(int(1000 * cosine), [60, 25, 2], cosine)
    assert found(spark, rows, block=block) == brute(rows)


def test_chains(spark):
    """Members far apart are one component through others; links are counted, not members."""
    rows = []
    for i in range(60):
        angle = i * 0.15
        rows.append((i, [math.cos(angle), math.sin(angle)] + [0.0] * 14))
    got = found(spark, rows, block=7)
    assert got == brute(rows) and {r[2] for r in got} == {0} and max(r[1] for r in got) < 12


def test_copies_and_scaled_copies(spark):
    rng = np.random.default_rng(6)
    base = [float(np.float32(x)) for x in unit(rng)]
    rows = [(i, base) for i in range(30, 60)] + [(i, [8 * x for x in base]) for i in range(10)] + [(70, [-x for x in base])]
    got = found(spark, rows)
    assert got == brute(rows) and got[0][1] == 39


def test_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    v = [3.0, 4.0, 0.0, 1.0]
    rows = [
        (1, v), (2, v), (2, v), (None, v), (None, [9.0, -1.0, 2.0, 0.0]), (3, None), (3, None), (4, []), (5, [0.0] * 4), (6, [0.0] * 4),
        (7, [nan, 1.0, 1.0, 1.0]), (8, [nan, 1.0, 1.0, 1.0]), (9, [inf, 0.0, 0.0, 0.0]), (10, [inf, 0.0, 0.0, 0.0]), (11, [1.0, None, 1.0, 1.0]),
        (12, [3.0, 4.0, 0.0]), (13, [1.0]), (14, [2.0]), (15, [-2.0]), (16, [3e38, 0.0, 0.0, 0.0]), (17, [1e-40, 0.0, 0.0, 0.0]),
        (18, [-0.0, 1.0, 0.0, 0.0]), (19, [0.0, 1.0, 0.0, 0.0]), (None, None),
    ]
    expected = sorted(((*r[:3], r[0] == r[2] if r[0] is not None else r[2] is None) for r in brute(rows)), key=repr)
    assert found(spark, rows) == expected


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    names = ["node", "members", "sketch", "cells", "sig", "component", "n", "class", "n_links", "kept", "label", "ring", "name"]
    rows = families(8, [5], 0.99, lone=5)
    assert found(spark, rows, lambda df: df.withColumns({c: F.lit("x") for c in names})) == brute(rows)


def test_long_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, unit(rng, 1_000).tolist()) for i in range(4)]
    rows += [(10 + i, close_to(rng, np.array(rows[0][1]), 0.98).tolist()) for i in range(3)]
    assert found(spark, rows) == brute(rows)


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted((tuple(r) for r in op13_lattice_dedup(spark, folder).collect()), key=repr) == brute(rows)
