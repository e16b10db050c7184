"""The prefix trie against a plain walk over all prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from starloom.llm import prefix_trie
from starloom.llm.queries import op11_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Conversations as lists of (role, text)."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))

    def tie(row):
        return row[0], row[1] or 0, hashlib.md5(f"{len(row[2])}:{row[2]}{row[3]}".encode()).digest()

    return {c: [r[2:] for r in sorted(turns, key=tie)] for c, turns in found.items()}


def rebuilt(talks):
    whole = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = talks.get(c - c % 100, [])[:h] + turns[h:]
    return whole


def plain_trie(talks):
    members = {}
    for c, turns in talks.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(c)
    nodes = set()
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    for path, convs in members.items():
        under = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(talks[c]) == len(path)))
        nodes.add(
            (
                min(convs),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(convs),
                len(children.get(path, [])),
                sum(p not in children for p in under),
                sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return nodes


def found(df):
    rows = df.select(COLUMNS).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def trie(spark, talks, size):
    turns = [(c, d + 1, f"{r}|{t}".encode(), len(t)) for c, turns in talks.items() for d, (r, t) in enumerate(turns)]
    counts = spark.createDataFrame([(c, len(t)) for c, t in talks.items()], "conv long, n_turns long")
    return prefix_trie.prefix_trie(counts, spark.createDataFrame(turns, "conv long, depth long, digest binary, length long"), size)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 7])
def test_random_tries(spark, size):
    random.seed(size)
    talks = {c: [("u", random.choice("ab") * random.randint(1, 2)) for _ in range(random.randint(0, 9))] for c in range(0, 240, 3)}
    talks |= {1000 + c: list(talks[3 * c]) for c in range(40)}
    assert found(trie(spark, talks, size)) == plain_trie(talks)


def test_a_long_conversation_and_its_copies(spark):
    turns = [("u", f"turn {i}") for i in range(400)]
    talks = {5: turns, 2: turns[:399], 9: list(turns), 11: turns[:200] + [("u", "else")], 12: []}
    assert found(trie(spark, talks, 4)) == plain_trie(talks)


def test_opening_turns_are_shared(spark):
    random.seed(7)
    rows = [
        (c, t, random.choice(["user", "assistant"]), random.choice(["hi", "yes", "no"]))
        for c in [*range(0, 40), *range(200, 230), 357, 399]
        for t in range(random.randint(1, 8))
    ]
    assert found(run(spark, rows)) == plain_trie(rebuilt(ordered(rows)))


def run(spark, rows, schema=SCHEMA, change=lambda df: df):
    turns = prefix_trie.ordered_turns(change(spark.createDataFrame(rows, schema)))
    shared = F.crc32(F.col("conv").cast("string")) % 6
    return prefix_trie.prefix_trie(*prefix_trie.share_openings(turns, F.col("conv") - F.col("conv") % 100, shared, 5))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, 0, "user", "x"),
        (100, None, "user", "first"),
        (100, 0, None, "second"),
        (100, 0, None, "second"),
        (100, 0, "user", "tie"),
        (101, 3, "user", None),
        (101, 3, "use", "r"),
        (101, 3, "user", ""),
        (102, 0, None, None),
        (103, 0, "user", "x" * 100_000),
    ]
    assert found(run(spark, rows)) == plain_trie(rebuilt(ordered(rows)))


def test_empty_table_and_clashing_columns(spark):
    assert found(run(spark, [])) == set()
    rows = [(c, t, "user", "x") for c in range(5) for t in range(c)]

    def clash(df):
        names = ["conv", "pos", "digest", "length", "_part", "depth", "node", "parent", "path", "owner", "n", "top", "_carried", "_sum0"]
        return df.withColumns({name: F.lit("clash") for name in names})

    assert found(run(spark, rows, change=clash)) == plain_trie(rebuilt(ordered(rows)))


def test_ids_of_a_large_node_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 64)
    ids = list(range(0, 30_000, 7))
    members = spark.createDataFrame([(b"a", i) for i in ids] + [(b"b", 3)], "node binary, conv long").repartition(8)
    got = {bytes(r.node): r.ends_sha256 for r in prefix_trie.id_digests(members).collect()}
    assert got == {
        b"a": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        b"b": hashlib.sha256(b"3").hexdigest(),
    }


def test_equal_conversations_are_one_row_before_nodes_are_made(spark):
    """The members of a node are never listed: equal conversations meet in one distinct block."""
    talks = {c: [("u", "a"), ("u", "b")] for c in range(500)}
    nodes = found(trie(spark, talks, 4))
    assert nodes == plain_trie(talks) and len(nodes) == 3


def test_the_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(op11_prefix_trie(spark, "/root/testdata/sf0.001")) == plain_trie(rebuilt(ordered(rows)))
