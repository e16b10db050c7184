"""Near duplicates among embeddings by lattice hashing.

A table projects the unit vectors to ``LATTICES`` times eight random dimensions
and decodes each eight to the nearest point of the lattice E8; the points
together are the vector's cell. Besides its own cell a vector enters the
``CELLS - 1`` nearest neighbouring ones: cells whose points differ by minimal
vectors of E8, by the distance from the projection. Vectors that share a cell in
any of the ``TABLES`` tables are candidates, whose cosine is verified in doubles.

Equal vectors are one node. Of each shared cell the members first meet one
centre; links are closed to components, and only members of a cell that still
lie in different components are held in blocks past which the others stream.
No pairs are made inside a component, and no group is collected.

All links of a vector lie in its component, so links are counted there, every
pair once and exactly. Components larger than a block are cut into rings around
their mean by angle: two rings close to the mean link as a whole, two far apart
not at all (the triangle inequality), and only rings in between are compared
vector by vector, in blocks.

Recall (simulated, pairs without a common neighbour): 0.97 at a cosine of 0.95,
above 0.999 from 0.98 on. Unrelated unit vectors of 64 dimensions share a cell
with a chance of about 1.4e-6, whatever the size of the table.

Defined results: vectors that are null, empty, zero or have a null or non-finite
component link with nothing and are components of their own; vectors of
different length are never compared; repeated rows count as other vectors; a
vector with a null id links and is counted but never names a component (null if
it has no other member) and is kept only then. Extra columns are not read.
Vectors are told apart by 64-bit hashes.
"""

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.jaccard import across, components
from starloom.llm.words import mix, slices
from starloom.session import work_folder

#: Least cosine of linked vectors.
LEAST = 0.95
TABLES, LATTICES, CELLS = 5, 3, 12
#: Length of a projected unit vector per root of a dimension; cells have volume 1.
SCALE = 0.65
#: Bits of 64 in which the sign sketches of a linked pair may differ before a centre is not tried.
SKETCH_BITS = 18
#: Vectors of a component that are held at once, and that stream past them in a task.
BLOCK, CHUNK = 2_048, 50_000
#: Rings are this fraction of the linking angle wide; angles are safe to this many radians.
_RINGS, _MARGIN = 16, 1e-6


def _minimal_vectors():
    """The 240 vectors next to a point of E8."""
    pairs = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((-1, 1), repeat=2):
            vector = np.zeros(8)
            vector[i], vector[j] = a, b
            pairs.append(vector)
    halves = [np.array(s) / 2 for s in itertools.product((-1, 1), repeat=8) if np.prod(s) > 0]
    return np.array(pairs + halves)


NEIGHBOURS = _minimal_vectors()


def _even_sum(y):
    """Nearest integer points with an even sum."""
    point = np.rint(y)
    rest = y - point
    odd = np.flatnonzero(point.sum(1).astype(np.int64) & 1)
    worst = np.abs(rest[odd]).argmax(1)
    point[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return point


def decode(y):
    """Nearest points of E8: integers with an even sum, or those shifted by a half."""
    whole, half = _even_sum(y), _even_sum(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(1) <= ((y - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def _choices(neighbours):
    """Ways to take up to two lattices to a neighbour: for each lattice 0 (stay) or the neighbour's place from 1."""
    ways = itertools.product(range(neighbours + 1), repeat=LATTICES)
    return np.array([w for w in ways if sum(c > 0 for c in w) <= 2])


_NEAREST = 8
_WAYS = _choices(_NEAREST)


class Tables:
    """Projections and hashes of all tables for one number of dimensions."""

    def __init__(self, size):
        rng = np.random.default_rng(size)
        wide = 8 * LATTICES
        self.project = np.stack([self._directions(rng, size, wide) for _ in range(TABLES)])
        self.project *= SCALE * np.sqrt(size)
        self.shift = rng.uniform(0, 2, (TABLES, wide))
        self.signs = self._directions(rng, size, 64)
        # A cell's key is a sum over twice its coordinates, so that a neighbour's key is the cell's plus a constant.
        self.factors = rng.integers(0, 2**64, (TABLES, LATTICES, 8), np.uint64)
        twice = (2 * NEIGHBOURS).astype(np.int64).astype(np.uint64)
        with np.errstate(over="ignore"):
            self.steps = (twice[None, None] * self.factors[:, :, None]).sum(3, dtype=np.uint64)
        self.salt = rng.integers(0, 2**64, TABLES, np.uint64)

    @staticmethod
    def _directions(rng, size, count):
        """``count`` random directions as columns, at right angles as far as there are dimensions."""
        bases = [np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(-(-count // size))]
        return np.concatenate(bases, axis=1)[:, :count]

    def cells(self, unit):
        """Keys of the own and the nearest neighbouring cells in every table."""
        n = len(unit)
        keys = np.empty((n, TABLES, CELLS), np.uint64)
        for t in range(TABLES):
            projected = unit @ self.project[t] + self.shift[t]
            total, extra, steps = np.zeros(n, np.uint64), np.zeros((n, len(_WAYS))), np.zeros((n, len(_WAYS)), np.uint64)
            for j in range(LATTICES):
                part = projected[:, 8 * j : 8 * j + 8]
                point = decode(part)
                # By how much farther the neighbours are than the nearest point, squared.
                farther = 2 - 2 * (part - point) @ NEIGHBOURS.T
                near = np.argpartition(farther, _NEAREST, axis=1)[:, :_NEAREST]
                farther = np.concatenate((np.zeros((n, 1)), np.take_along_axis(farther, near, 1)), 1)
                step = np.concatenate((np.zeros((n, 1), np.uint64), self.steps[t, j][near]), 1)
                extra += farther[:, _WAYS[:, j]]
                with np.errstate(over="ignore"):
                    steps += step[:, _WAYS[:, j]]
                    total += ((2 * point).astype(np.int64).astype(np.uint64) * self.factors[t, j]).sum(1, dtype=np.uint64)
            best = np.argpartition(extra, CELLS - 1, axis=1)[:, :CELLS]
            with np.errstate(over="ignore"):
                keys[:, t] = mix(total[:, None] + np.take_along_axis(steps, best, 1) + self.salt[t])
        return keys.reshape(n, -1).view(np.int64)

    def sketches(self, unit):
        """Signs along 64 directions, as a 64-bit integer."""
        return np.packbits(unit @ self.signs >= 0, axis=1).view(np.int64)[:, 0]


@lru_cache(8)
def tables(size):
    return Tables(size)


def _hash_nodes(batches):
    """Nodes -> unit vectors, sketches and cells."""
    for batch in slices(batches):
        vectors = batch.column("embedding")
        length = vectors.value_lengths().to_numpy()
        values = vectors.flatten().to_numpy()
        start = np.concatenate(([0], length.cumsum()))
        for size in np.unique(length):
            rows = np.flatnonzero(length == size)
            vector = values[start[rows][:, None] + np.arange(size)]
            vector = vector / np.abs(vector).max(1, keepdims=True)
            unit = vector / np.sqrt((vector * vector).sum(1, keepdims=True))
            cells, sketches = tables(int(size)).cells(unit), tables(int(size)).sketches(unit)
            columns = [
                batch.column("node").take(pa.array(rows)),
                pa.array([u.tobytes() for u in unit], pa.binary()),
                pa.array(sketches),
                pa.array(list(cells), pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "members", "sketch", "cells"])


def _verify(least):
    def verify(batches):
        for batch in slices(batches):
            keep = [
                bool(a.as_buffer().size == b.as_buffer().size and _cosine(a.as_buffer(), b.as_buffer()) >= least)
                for a, b in zip(batch.column("one"), batch.column("other"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _cosine(a, b):
    return float(np.dot(np.frombuffer(a, np.float64), np.frombuffer(b, np.float64)))


class _Held:
    """A block of vectors of one length past which others stream."""

    def __init__(self, held, least):
        self.least = least
        self.node, self.component = ([r[i] for r in held] for i in range(2))
        self.vectors = {}
        for i, (_, _, vector) in enumerate(held):
            self.vectors.setdefault(len(vector), []).append(i)
        self.vectors = {n: (rows, np.array([held[i][2].view(np.float64) for i in rows])) for n, rows in self.vectors.items()}
        self.known = set()

    def linked(self, values, component):
        """Held vectors of other components that link with a vector; one for each pair of components."""
        rows, held = self.vectors.get(len(values), ([], np.zeros((0, len(values)))))
        for at in np.flatnonzero(held @ values.view(np.float64) >= self.least):
            pair = component, self.component[rows[at]]
            if pair[0] != pair[1] and pair not in self.known:
                self.known.add(pair)
                yield self.node[rows[at]]


def _written(df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def node_components(nodes: DataFrame, folder: str, least=LEAST) -> DataFrame:
    """``node, component`` of the nodes that link with others. ``nodes`` has ``node, members, sketch, cells``."""
    entered = nodes.select(F.explode("cells").alias("sig"), "node", "sketch")
    shared = entered.groupBy("sig").agg(F.min(F.struct("node", "sketch")).alias("centre"), F.max("node").alias("last"))
    shared = _written(shared.where("centre.node <> last").select("sig", "centre"), folder, "shared")
    met = _written(entered.join(shared, "sig"), folder, "met")
    alike = F.bit_count(F.col("sketch").bitwiseXOR(F.col("centre.sketch"))) <= SKETCH_BITS
    stars = met.where((F.col("node") != F.col("centre.node")) & alike)
    stars = _written(stars.select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct(), folder, "stars")
    one = nodes.select(F.col("node").alias("a"), F.col("members").alias("one"))
    other = nodes.select(F.col("node").alias("b"), F.col("members").alias("other"))
    tried = stars.join(one, "a").join(other, "b").select("a", "b", "one", "other")
    first = components(tried.mapInArrow(_verify(least), "a bigint, b bigint"), f"{folder}/first")
    # The centre has met all others of its cell; a cell of two is done.
    more = met.groupBy("sig").agg(F.count("node").alias("n")).where("n > 2").select("sig")
    members = met.select("sig", "node").join(_written(more, folder, "more"), "sig")
    labelled = members.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    found = _written(
        across(labelled, nodes.select("node", "members"), lambda held: _Held(held, least), folder), folder, "across"
    )
    if found.isEmpty():
        return first
    return components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(found), f"{folder}/second")


def _sums(batches):
    """Members -> sums of a batch's unit vectors by component, a row per dimension."""
    for batch in slices(batches):
        sums = {}
        for component, unit in zip(batch.column("component").to_pylist(), batch.column("members")):
            unit = np.frombuffer(unit.as_buffer(), np.float64)
            sums[component] = sums[component] + unit if component in sums else unit
        names = [c for c, total in sums.items() for _ in total]
        places = [i for total in sums.values() for i in range(len(total))]
        columns = [pa.array(names, pa.int64()), pa.array(places, pa.int32()), pa.array([x for t in sums.values() for x in t], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["component", "i", "x"])


def _angles(batches):
    """Members with the sum of their component's vectors -> angle to it."""
    for batch in slices(batches):
        angles = []
        for middle, unit in zip(batch.column("middle"), batch.column("members")):
            middle = middle.values.to_numpy()
            length = np.sqrt(np.dot(middle, middle))
            angles.append(np.arccos(np.clip(np.dot(middle, np.frombuffer(unit.as_buffer(), np.float64)) / (length or 1), -1, 1)))
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(angles, pa.float64())], ["node", "angle"])


_COUNTING = ["component", "ring", "block", "chunk", "role", "node", "n", "members"]


def _count(least):
    """Rows sorted by component, ring, block and chunk, held vectors first -> copies of held vectors that link with a streamed one."""

    def count(batches):
        key, held, matrix, names, copies = None, [], None, None, None
        for batch in slices(batches):
            nodes, links = [], []
            rows = list(zip(*[batch.column(c).to_pylist() for c in _COUNTING]))
            for place, part in itertools.groupby(rows, lambda r: r[:5]):
                part = list(part)
                if place[:4] != key:
                    key, held, matrix = place[:4], [], None
                if place[4] == 0:
                    held += part
                    continue
                if matrix is None:
                    matrix = np.array([np.frombuffer(r[7], np.float64) for r in held])
                    names, copies = np.array([r[5] for r in held]), np.array([r[6] for r in held])
                unit = np.array([np.frombuffer(r[7], np.float64) for r in part])
                asked = np.array([r[5] for r in part])
                near = (unit @ matrix.T >= least) & (asked[:, None] != names[None])
                nodes.append(asked)
                links.append(near @ copies)
            columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in (nodes, links)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "links"])

    return count


def link_counts(found: DataFrame, nodes: DataFrame, folder: str, least=LEAST, block=BLOCK) -> DataFrame:
    """``node, links``: rows of other nodes of the component ``found`` that link with a node, each pair compared or implied once."""
    members = _written(found.join(nodes.select("node", "n", "members"), "node"), folder, "linked")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))
    large = _written(sizes.where(F.col("nodes") > block).select("component"), folder, "large")
    parts = members.select("component", "members").join(large, "component").mapInArrow(_sums, "component bigint, i int, x double")
    middles = parts.groupBy("component", "i").agg(F.sum("x").alias("x")).groupBy("component")
    middles = middles.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("middle"))
    near = members.select("component", "node", "members").join(_written(middles, folder, "middles"), "component")
    angles = near.select("node", "members", "middle").mapInArrow(_angles, "node bigint, angle double")
    angle = float(np.arccos(least))
    width = angle / _RINGS
    # Components of one block are one ring.
    ring = F.coalesce(F.floor(F.col("angle") / width), F.lit(-1)).cast("int")
    placed = _written(members.join(angles, "node", "left").withColumn("ring", ring).drop("angle"), folder, "rings")
    rings = placed.groupBy("component", "ring").agg(F.sum("n").alias("copies"), F.count(F.lit(1)).alias("nodes"))
    rings = _written(rings.withColumn("blocks", F.ceil(F.col("nodes") / block)), folder, "ring_sizes")
    # Every two rings of a component; a component has at most pi / width of them.
    other = rings.select("component", F.struct(F.col("ring"), "copies", "blocks").alias("other"))
    pairs = rings.select("component", "ring").join(other, "component")
    apart = F.abs(F.col("ring") - F.col("other.ring")) - 1
    sure = (F.col("ring") >= 0) & ((F.col("ring") + F.col("other.ring") + 2) * width <= angle - _MARGIN)
    unsure = ~sure & (apart * width <= angle + _MARGIN)
    implied = pairs.where(sure).groupBy("component", "ring").agg(F.sum("other.copies").alias("implied"))
    implied = placed.join(_written(implied, folder, "implied"), ["component", "ring"])
    # A node of a ring that links as a whole also counted its own copies.
    own = F.when((F.col("ring") + 1) * 2 * width <= angle - _MARGIN, F.col("n")).otherwise(0)
    implied = implied.select("node", (F.col("implied") - own).alias("links"))

    chunks = rings.select("component", F.col("ring").alias("from_ring"), F.ceil(F.col("nodes") / CHUNK).alias("chunks"))
    to_compare = pairs.where(unsure).select("component", F.col("ring").alias("from_ring"), F.col("other.ring").alias("ring"), "other.blocks")
    to_compare = _written(to_compare.join(chunks, ["component", "from_ring"]), folder, "compare")
    in_block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    every = lambda n, name: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)).alias(name)
    held = placed.join(to_compare, ["component", "ring"]).select(
        "component", "ring", in_block, "from_ring", every("chunks", "chunk"), F.lit(0).alias("role"), "node", "n", "members"
    )
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).alias("chunk")
    asking = placed.withColumnRenamed("ring", "from_ring").join(to_compare, ["component", "from_ring"]).select(
        "component", "ring", every("blocks", "block"), "from_ring", chunk, F.lit(1).alias("role"), "node", "n", "members"
    )
    dealt = held.unionByName(asking).withColumn("chunk", F.struct("from_ring", "chunk")).select(*_COUNTING)
    dealt = dealt.repartition(*_COUNTING[:4]).sortWithinPartitions(*_COUNTING[:5])
    compared = dealt.mapInArrow(_count(least), "node bigint, links bigint")
    return compared.unionByName(implied).groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, least=LEAST, block=BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``vec_id, embedding``."""
    folder = work_folder(vectors.sparkSession, "lattice")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = finite & F.exists("embedding", lambda x: x != 0)
    named = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = named.withColumn("node", F.when(usable, F.xxhash64("embedding")))
    ids = _written(rows.select("vec_id", "node"), folder, "ids")
    distinct = rows.where("node is not null").groupBy("node").agg(F.first("embedding").alias("embedding"))
    schema = "node bigint, members binary, sketch bigint, cells array<bigint>"
    nodes = _written(distinct.mapInArrow(_hash_nodes, schema), folder, "nodes")
    found = _written(node_components(nodes, folder, least), folder, "found")
    copies = _written(ids.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("n")), folder, "copies")
    links = link_counts(found, nodes.join(copies, "node"), f"{folder}/counts", least, block)
    known = copies.join(found, "node", "left").join(links, "node", "left")
    known = _written(
        known.select(
            "node",
            F.coalesce("component", "node").alias("class"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"),
        ),
        folder,
        "known",
    )
    labelled = ids.join(known, "node", "left")
    names = labelled.where("class is not null").groupBy("class").agg(F.min("vec_id").alias("name"))
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("name"))
    whole = labelled.join(_written(names, folder, "names"), "class", "left").withColumn("component_id", component)
    return whole.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
