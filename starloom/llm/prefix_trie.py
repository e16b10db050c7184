"""Conversation prefix trie by fixed-length block hashing.

The turns of a conversation are cut into blocks of ``BLOCK`` turns. A block's
digest covers its turns, a conversation's place before a block is the sum of
the hashes of all its earlier blocks (a sum, so that even one conversation with
very many turns is summed in a distributed way). Conversations are first
grouped by place and block digest: equal blocks at equal places become one row
with the number of members and the least of them. Where a place is followed by
one block only, its turns are nodes as they are; only where sibling blocks
diverge are they cut into turn prefixes and grouped again.

Sums over subtrees need no walk over depths. A node is owned by its least
member, so what a node adds is an entry of one conversation; later entries of a
conversation are summed and then added up per distinct block, over its members.
Inside a block a node adds to its at most ``BLOCK`` ancestors there.

A digest of member ids is one SHA-256 over all of them in order, which cannot
be split: the ids are joined to pieces in parallel, and only pieces are streamed
through one task per node.

Defined results: a null role or text is empty; turns come in the order of
``turn`` (null first), equal ones in the order of the MD5 of role and text;
repeated rows are repeated turns; rows with a null ``conv_id`` belong to no
conversation; without conversations there are no nodes, not even the root. Extra
columns are not read. Turns are told apart by MD5, places by the sums of two
64-bit hashes.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.prefix import running_sums
from starloom.session import work_folder

#: Turns in a block.
BLOCK = 4
#: Bytes of joined member ids in a piece, about.
PIECE = 1 << 16
EMPTY_SHA256 = hashlib.sha256().hexdigest()
_TWO = ("p", "q")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv, pos`` (from 1), ``digest, length`` (code points of the text) of every turn; texts go no further."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("bigint").alias("length"),
    )
    placed = running_sums(turns, ["conv"], ["turn", "digest"], {"pos": F.lit(1).cast("bigint")})
    return placed.select("conv", "pos", "digest", "length")


def share_openings(turns: DataFrame, base, n_shared, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the opening of another one: ``(conv, n_turns)`` and their turns.

    ``base`` and ``n_shared`` are columns over ``conv``: the first ``n_shared``
    (at most ``longest``) turns are those of conversation ``base``, then the
    own turns after as many follow.
    """
    folder = work_folder(turns.sparkSession, "openings")
    turns = _written(turns, folder, "turns")
    counts = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).select("conv", "own", base.alias("base"), n_shared.alias("h"))
    heads = turns.where(F.col("pos") <= longest)
    lengths = heads.groupBy(F.col("conv").alias("base")).agg(F.count(F.lit(1)).alias("there"))
    given = F.least("h", F.coalesce("there", F.lit(0).cast("bigint")))
    convs = _written(counts.join(lengths, "base", "left").select("conv", "base", "h", "own", given.alias("given")), folder, "convs")
    opening = (
        convs.join(heads.withColumnRenamed("conv", "base"), "base")
        .where("pos <= given")
        .select("conv", F.col("pos").alias("depth"), "digest", "length")
    )
    rest = turns.join(convs.where("own > h"), "conv").where("pos > h")
    rest = rest.select("conv", (F.col("pos") - F.col("h") + F.col("given")).alias("depth"), "digest", "length")
    n_turns = F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return convs.select("conv", n_turns.cast("bigint").alias("n_turns")), opening.unionByName(rest)


def _written(df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _boundary(number, p, q):
    """Key of the node where block ``number`` begins."""
    return F.unhex(F.md5(F.concat_ws("/", F.lit("at"), number, p, q)))


def _inner(number, p, q, digests):
    """Key of a node inside block ``number``."""
    return F.unhex(F.md5(F.concat_ws("/", F.lit("in"), number, p, q, F.hex(F.concat(F.lit(b""), digests)))))


def chained_blocks(turns: DataFrame, n_turns: DataFrame, size: int) -> DataFrame:
    """A row per conversation and block: the turns, the place before and after, the keys of its nodes."""
    number = F.floor((F.col("depth") - 1) / size).cast("bigint")
    cut = turns.groupBy("conv", number.alias("number")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "digest", "length"))).alias("turns")
    )
    digest = F.unhex(F.md5(F.aggregate("turns", F.lit("").cast("binary"), lambda a, t: F.concat(a, t["digest"]))))
    cut = cut.withColumn("block", digest)
    # The hash of a block and its number, twice 64 bits; sums of decimals do not overflow.
    added = {c: F.xxhash64("number", "block", F.lit(i)).cast("decimal(20,0)") for i, c in enumerate(_TWO)}
    sums = {f"{c}_to": hashed for c, hashed in added.items()}
    chained = running_sums(cut, ["conv"], ["number"], sums).withColumns({c: F.col(f"{c}_to") - added[c] for c in _TWO})
    return chained.join(n_turns, "conv").withColumn("ends", F.col("number") == F.floor((F.col("n_turns") - 1) / size))


def _paths(blocks: DataFrame, size: int) -> DataFrame:
    """``path``: the keys of a block's nodes, turn by turn; ``before``: the key of the node it begins at."""

    def key(i):
        digests = F.aggregate(F.slice("turns", 1, i), F.lit("").cast("binary"), lambda a, t: F.concat(a, t["digest"]))
        inner = _inner(F.col("number"), F.col("p"), F.col("q"), digests)
        return F.when(i == size, _boundary(F.col("number") + 1, F.col("p_to"), F.col("q_to"))).otherwise(inner)

    keys = F.transform(F.sequence(F.lit(1), F.size("turns")), key)
    return blocks.withColumns({"path": keys, "before": _boundary(F.col("number"), F.col("p"), F.col("q"))})


def _hash_pieces(batches):
    """Pieces sorted by node and first id -> SHA-256 of each node's ids."""
    node, state = None, None
    for batch in batches:
        done = []
        for key, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key == node:
                state.update(b"," + text.encode())
            else:
                if state:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(text.encode())
        yield _digests(done)
    if state:
        yield _digests([(node, state.hexdigest())])


def _digests(done):
    columns = [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["node", "ends_sha256"])


def _join_ids(batches):
    """Ids sorted by node and id -> pieces of joined ids."""
    node, first, ids, size = None, None, [], 0
    for batch in batches:
        done = []
        for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist()):
            if key != node or size > PIECE:
                if ids:
                    done.append((node, first, ",".join(ids)))
                node, first, ids, size = key, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield _pieces(done)
    if ids:
        yield _pieces([(node, first, ",".join(ids))])


def _pieces(done):
    kinds = zip(zip(*done) if done else ([], [], []), (pa.binary(), pa.int64(), pa.string()))
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in kinds], ["node", "first", "ids"])


def id_digests(members: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of ``node, conv``: SHA-256 of the ids in ascending order, comma-joined.

    The ids of a node with very many are cut over partitions by range and
    joined there; one task per node streams the pieces.
    """
    cut = members.select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    pieces = cut.mapInArrow(_join_ids, "node binary, first bigint, ids string")
    dealt = pieces.repartition("node").sortWithinPartitions("node", "first")
    return dealt.mapInArrow(_hash_pieces, "node binary, ends_sha256 string")


def prefix_trie(n_turns: DataFrame, turns: DataFrame, size=BLOCK) -> DataFrame:
    """The nodes of the trie of all conversations.

    ``n_turns`` has ``conv, n_turns`` (0 for a conversation without turns),
    ``turns`` has ``conv, depth`` (1, 2, ...), ``digest, length``. Returns per
    node ``conv_id`` (least member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    folder = work_folder(n_turns.sparkSession, "trie")
    rows = _written(_paths(chained_blocks(turns, n_turns, size), size), folder, "blocks")
    root = _boundary(F.lit("0"), F.lit("0"), F.lit("0"))

    # Distinct blocks: everything below works on these, not on members.
    distinct = _written(
        rows.groupBy("before", "number", "block").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv").alias("owner"),
            F.count_if("ends").alias("n_ends"),
            F.first("path").alias("path"),
            F.first(F.transform("turns", lambda t: t["length"])).alias("lengths"),
        ),
        folder,
        "distinct",
    )
    siblings = _written(distinct.groupBy("before").agg((F.count(F.lit(1)) > 1).alias("diverging")), folder, "siblings")
    split = distinct.join(siblings, "before")
    at = F.posexplode(F.arrays_zip("path", "lengths")).alias("i", "turn")
    exploded = split.select("*", at).select(
        "diverging",
        F.col("turn.path").alias("node"),
        F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("path", F.col("i") - 1)).alias("parent"),
        (F.col("number") * size + F.col("i") + 1).alias("depth"),
        "owner",
        "n",
        F.when(F.col("i") + 1 == F.size("path"), F.col("n_ends")).otherwise(0).cast("bigint").alias("n_ends"),
        F.col("turn.lengths").alias("length"),
        F.slice("path", 1, F.col("i") + 1).alias("path"),
    )
    straight = exploded.where("not diverging").drop("diverging")
    refined = exploded.where("diverging").groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("owner").alias("owner"),
        F.sum("n").alias("n"),
        F.sum("n_ends").alias("n_ends"),
        F.first("length").alias("length"),
        F.first("path").alias("path"),
    )
    zero = F.lit(0).cast("bigint")
    counted = n_turns.agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_turns") == 0).alias("n_ends"))
    top = counted.where("n > 0").select(
        root.alias("node"),
        F.lit(None).cast("binary").alias("parent"),
        zero.alias("depth"),
        "owner",
        "n",
        "n_ends",
        zero.alias("length"),
        F.array(root).alias("path"),
    )
    nodes = straight.unionByName(refined).unionByName(top)
    nodes = nodes.withColumns(
        # All members of a leaf end there.
        {"saved": (F.col("n") - 1) * F.col("length"), "leaf": (F.col("n_ends") == F.col("n")).cast("bigint")}
    )
    nodes = _written(nodes, folder, "nodes")

    # What the nodes of later blocks add, by owner, summed from the end of each conversation.
    number = F.floor((F.col("depth") - 1) / size).alias("number")
    owned = nodes.where("depth > 0 and (saved > 0 or leaf > 0)").groupBy(F.col("owner").alias("conv"), number)
    owned = owned.agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    entries = rows.select("conv", "number", "before", "block").join(owned, ["conv", "number"], "left")
    kept = entries.na.fill(0, ["saved", "leaf"])
    later = running_sums(
        kept, ["conv"], [F.desc("number")], {"saved_to": F.col("saved"), "leaf_to": F.col("leaf")}
    )
    below = later.groupBy("before", "number", "block").agg(
        F.sum(F.col("saved_to") - F.col("saved")).alias("saved"), F.sum(F.col("leaf_to") - F.col("leaf")).alias("leaf")
    )
    below = below.where("saved > 0 or leaf > 0").join(distinct.select("before", "number", "block", "path"), ["before", "number", "block"])

    # In its block a node adds to its ancestors there; in the first block also to the root.
    def with_root(df, first):
        return df.select(F.when(first, F.concat(F.array(root), "path")).otherwise(F.col("path")).alias("path"), "saved", "leaf")

    adding = with_root(nodes, F.col("depth").between(1, size)).unionByName(with_root(below, F.col("number") == 0))
    added = adding.select(F.explode("path").alias("node"), "saved", "leaf", zero.alias("child"))
    children = nodes.where("parent is not null").select(
        F.col("parent").alias("node"), zero.alias("saved"), zero.alias("leaf"), F.lit(1).cast("bigint").alias("child")
    )
    sums = added.unionByName(children).groupBy("node").agg(*[F.sum(c).alias(f"sum_{c}") for c in ("saved", "leaf", "child")])

    last = rows.where("ends").select(F.element_at("path", -1).alias("node"), "conv")
    turnless = n_turns.where("n_turns = 0").select(root.alias("node"), "conv")
    ends = id_digests(last.unionByName(turnless))
    parents = nodes.select(F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"))
    whole = nodes.drop("saved", "leaf", "path").join(sums, "node").join(ends, "node", "left").join(parents, "parent", "left")
    return whole.select(
        F.col("owner").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.col("sum_child").alias("n_children"),
        F.col("sum_leaf").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
