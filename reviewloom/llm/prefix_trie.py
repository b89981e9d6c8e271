"""The trie of conversation prefixes, with sums over subtrees by centroid decomposition.

Conversations are sequences of turns (role, text). Each distinct sequence of first turns is a
node; the conversations that begin with it are its members. A node is named by its smallest
member and its depth. Names come from running hashes: turns are numbered in ranges of their
order, a prefix has the XOR of 128 bits for its turns at their places, made in blocks of
places so that a long conversation is no single task, and each node is checked to hold one
SHA-256 of its last turn, so that two sequences can never be taken for one.

Sums over subtrees follow the parent edges by centroid decomposition (``centroids``). The
weight of a node is the number of its members, and then the weight of a subtree is known
beforehand: the turns that its members still have to go. A component of more than
``TOGETHER`` nodes is split by a join: a node lies below the centroid if its smallest member
passes it, which the table of (conversation, depth) tells, and so does the child's part it
falls into. Each split halves the weight, so there are few rounds even in a trie that is one
long path. Smaller components are finished inside tasks, many of them in one.

Defined results: rows without a conversation id go; null role or text is empty; turns come in
the order of their number, nulls first, then role, then the hash of the text, repeated rows
each counting; an id's remainder has the sign of the id; an empty table has no nodes; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .centroids import subtree_sums
from .ordering import numbered
from .scratch import Scratch, bounded_batches

#: Conversations that may share the head of their first one.
FAMILY = 20
#: A conversation takes fewer than this many turns from its family's first one.
HEADS = 4
#: Places of a block of turns.
BLOCK = 64
#: Nodes of a component that one task finishes.
TOGETHER = 4096
#: Nodes that a task finishes together, about.
DEALT = 40_000
#: Conversation ids whose list is made at once.
CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"


def _ordered_turns(conversations: DataFrame, names: tuple[str, str, str, str], scratch: Scratch) -> DataFrame:
    """(conv, pos from 1, sha, words) of the turns, and nothing of their texts."""
    conv, turn, role, text = (F.col(x) for x in names)
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    turns = conversations.filter(conv.isNotNull()).select(
        conv.cast("long").alias("conv"), turn.alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("sha"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")]
    return numbered(turns, order, "at", scratch).select("conv", "at", "sha", "words")


def family_heads(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Conversations with the heads of their families put before their own later turns.

    Returns (conv, d, sha, words) and (conv, length).
    """
    stats = turns.groupBy("conv").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    stats = scratch.put(
        stats.withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
        .withColumn("h", F.crc32(F.col("conv").cast("string")) % HEADS)
        .withColumn("h", F.when(F.col("conv") == F.col("base"), 0).otherwise(F.col("h")))
    )
    first = stats.filter("conv = base").select(F.col("conv").alias("first"), F.col("n").alias("n_first"))
    plan = scratch.put(
        stats.join(first, F.col("base") == F.col("first"), "left")
        .select("conv", "start", "base", "h", "n", F.least("h", F.coalesce("n_first", F.lit(0))).alias("lent"))
    )
    placed = scratch.put(
        turns.join(plan.select("conv", "start", "h", "lent"), "conv")
        .withColumn("pos", F.col("at") - F.col("start") + 1)
        .select("conv", "pos", "h", "lent", "sha", "words")
    )
    own = placed.filter("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("lent")).alias("d"), "sha", "words")
    heads = placed.filter((F.col("pos") < HEADS) & (F.col("conv") % FAMILY == 0)).select(
        F.col("conv").alias("base"), "pos", "sha", "words"
    )
    lent = (
        plan.filter("conv <> base").select("conv", "base", "h").join(heads, "base").filter("pos <= h")
        .select("conv", F.col("pos").alias("d"), "sha", "words")
    )
    lengths = plan.select("conv", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return own.union(lent), lengths


def _prefixes(turns: DataFrame, lengths: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """(conv, d, length, p1, p2, q1, q2, sha, words): the running hashes p of each prefix, the
    empty one too, and q of the prefix before it."""
    hashed = (
        turns.withColumn("block", F.floor(F.col("d") / BLOCK))
        .withColumn("h1", F.xxhash64(F.lit(seed), "d", "sha"))
        .withColumn("h2", F.xxhash64("sha", "d", F.lit(seed + 1)))
    )
    hashed = scratch.put(hashed)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("conv", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
        .withColumn("s1", F.coalesce(F.bit_xor("b1").over(before), F.lit(0)))
        .withColumn("s2", F.coalesce(F.bit_xor("b2").over(before), F.lit(0)))
        .drop("b1", "b2")
    )
    inside = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        hashed.join(starts, ["conv", "block"])
        .withColumn("p1", F.bit_xor("h1").over(inside).bitwiseXOR(F.col("s1")))
        .withColumn("p2", F.bit_xor("h2").over(inside).bitwiseXOR(F.col("s2")))
        .join(lengths, "conv")
        .select(
            "conv", "d", "length", "p1", "p2", F.col("p1").bitwiseXOR(F.col("h1")).alias("q1"),
            F.col("p2").bitwiseXOR(F.col("h2")).alias("q2"), "sha", "words",
        )
    )
    zero = F.lit(0).cast("long")
    top = lengths.select(
        "conv", zero.alias("d"), "length", *[zero.alias(x) for x in ("p1", "p2", "q1", "q2")],
        F.lit(None).cast("binary").alias("sha"), zero.alias("words"),
    )
    return scratch.put(running.union(top))


def _end_hashes(paths: DataFrame) -> DataFrame:
    """(r, d, ends_sha256) of the nodes where conversations end.

    The ids are joined in chunks of neighbouring ids; a task then walks the chunks of a node
    in order and holds one chunk at a time.
    """
    chunks = (
        paths.filter("d = length").groupBy("r", "d", F.floor(F.col("conv") / CHUNK).alias("chunk"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None
        for batch in batches:
            found = []
            for r, d, ids in zip(*(batch.column(x).to_pylist() for x in ("r", "d", "ids")), strict=True):
                if node != (r, d):
                    if node is not None:
                        found.append((*node, digest.hexdigest()))
                    node, digest = (r, d), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(found)
        if node is not None:
            yield _rows([(*node, digest.hexdigest())])

    return (
        chunks.repartition("r", "d").sortWithinPartitions("r", "d", "chunk")
        .select("r", "d", "ids").mapInArrow(run, "r long, d long, ends_sha256 string")
    )


def _rows(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[], [], []]
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["r", "d", "ends_sha256"]
    )


def _finish(table: pa.Table) -> pa.Table:
    """Whole components, all that is left of them summed inside the task."""
    r, d, pr, tr, td, v1, v2, s1, s2 = (
        table.column(x).to_pylist() for x in ("r", "d", "pr", "tr", "td", "v1", "v2", "s1", "s2")
    )
    at = {node: i for i, node in enumerate(zip(r, d, strict=True))}
    parents = [
        -1 if (a, b) == (x, y) else at[(p, b - 1)] for a, b, p, x, y in zip(r, d, pr, tr, td, strict=True)
    ]
    sums = subtree_sums(parents, list(zip(v1, v2, strict=True)))
    return pa.table({
        "r": pa.array(r, pa.int64()), "d": pa.array(d, pa.int64()),
        "s1": pa.array([a + x[0] for a, x in zip(s1, sums, strict=True)], pa.int64()),
        "s2": pa.array([a + x[1] for a, x in zip(s2, sums, strict=True)], pa.int64()),
    })


def centroid_rollup(nodes: DataFrame, paths: DataFrame, scratch: Scratch, together: int = TOGETHER) -> DataFrame:
    """(r, d, s1, s2): the sums of v1 and v2 over the subtree of each node (r, d).

    ``nodes``: r, d, pr (the parent is (pr, d - 1)), tr and td (the top of the tree), m (the
    weight of the subtree, more than that of all children), v1, v2. ``paths``: for each name
    r and depth d, the node (r, d) that is passed there, and pr, the one above.
    """
    zero = F.lit(0).cast("long")
    state = scratch.put(nodes.withColumn("s1", zero).withColumn("s2", zero))
    small, done = [], []
    while True:
        sizes = state.groupBy("tr", "td").agg(F.count(F.lit(1)).alias("k"), F.max("m").alias("total"))
        large = scratch.put(sizes.filter(F.col("k") > together).select("tr", "td", "total"))
        if large.isEmpty():
            small.append(state)
            break
        small.append(scratch.put(state.join(large, ["tr", "td"], "left_anti")))
        own = scratch.put(state.join(large, ["tr", "td"]))
        scratch.drop(state, large)
        centroids = scratch.put(
            own.filter("2 * m > total").groupBy("tr", "td").agg(F.max(F.struct("d", "r", "m")).alias("z"))
            .select("tr", "td", F.col("z.d").alias("zd"), F.col("z.r").alias("zr"), F.col("z.m").alias("zm"))
        )
        passed = paths.select(
            F.col("conv").alias("r"), F.col("d").alias("at"), F.col("r").alias("child"), F.col("pr").alias("above")
        )
        marked = scratch.put(
            own.drop("total").join(centroids, ["tr", "td"]).withColumn("at", F.col("zd") + 1)
            .join(passed, ["r", "at"], "left")
            .withColumn("is_z", F.expr("d = zd and r = zr"))
            .withColumn("below", F.expr("d > zd and above = zr"))
        )
        scratch.drop(own)
        totals = marked.filter("is_z or below").groupBy("tr", "td").agg(F.sum("v1").alias("t1"), F.sum("v2").alias("t2"))
        up = (
            centroids.join(totals, ["tr", "td"])
            .join(paths.select(F.col("conv").alias("zr"), F.col("d").alias("on"), F.col("r").alias("passes")), "zr")
            .filter("`on` between td and zd")
            .select(
                F.col("passes").alias("r"), F.col("on").alias("d"), "t1", "t2",
                F.when(F.col("on") < F.col("zd"), F.col("zm")).otherwise(0).alias("less"),
            )
        )
        after = scratch.put(
            marked.join(up, ["r", "d"], "left").select(
                "r", "d", "pr",
                F.when(F.col("below"), F.col("child")).otherwise(F.col("tr")).alias("tr"),
                F.when(F.col("below"), F.col("at")).otherwise(F.col("td")).alias("td"),
                (F.col("m") - F.coalesce("less", F.lit(0))).alias("m"), "v1", "v2",
                (F.col("s1") + F.coalesce("t1", F.lit(0))).alias("s1"),
                (F.col("s2") + F.coalesce("t2", F.lit(0))).alias("s2"),
                "is_z",
            )
        )
        scratch.drop(marked, centroids)
        done.append(scratch.put(after.filter("is_z").select("r", "d", "s1", "s2")))
        state = scratch.put(after.filter("not is_z").drop("is_z"))
        scratch.drop(after)
    left = reduce(DataFrame.unionByName, small).drop("m")
    groups = max(1, -(-left.count() // DEALT))
    finished = (
        left.withColumn("g", F.pmod(F.xxhash64("tr", "td"), F.lit(groups)))
        .groupBy("g").applyInArrow(_finish, "r long, d long, s1 long, s2 long")
    )
    return reduce(DataFrame.unionByName, done, finished)


def prefix_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", together: int = TOGETHER,
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "prefix-trie")
    turns = _ordered_turns(conversations, (conv_col, turn_col, role_col, text_col), scratch)
    rebuilt, lengths = family_heads(turns, scratch)
    rebuilt, lengths = scratch.put(rebuilt), scratch.put(lengths)
    seed = 1
    while True:
        prefixes = _prefixes(rebuilt, lengths, seed, scratch)
        named = scratch.put(
            prefixes.groupBy("d", "p1", "p2").agg(
                F.min("conv").alias("r"), F.count(F.lit(1)).alias("n_convs"), F.sum("length").alias("turns"),
                F.max("words").alias("words"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
                F.min("sha").alias("lo"), F.max("sha").alias("hi"),
            )
        )
        if named.filter("lo <> hi").isEmpty():
            break
        scratch.drop(prefixes, named)
        seed += 2
    above = named.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("r").alias("pr"))
    nodes = scratch.put(
        named.join(above, ["d", "q1", "q2"], "left").select(
            "r", "d", "pr", "p1", "p2", "n_convs",
            (F.col("turns") - F.col("n_convs") * (F.col("d") - 1)).alias("m"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("v2"),
        )
    )
    paths = scratch.put(
        prefixes.select("conv", "d", "length", "p1", "p2")
        .join(nodes.select("d", "p1", "p2", "r", "pr"), ["d", "p1", "p2"])
        .select("conv", "d", "length", "r", "pr")
    )
    scratch.drop(prefixes, named)
    children = nodes.filter("pr is not null").groupBy(F.col("pr").alias("r"), (F.col("d") - 1).alias("d")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = scratch.put(
        nodes.drop("p1", "p2").join(children, ["r", "d"], "left").fillna(0, ["n_children"])
        .withColumn("v1", (F.col("n_children") == 0).cast("long"))
    )
    root = nodes.filter("d = 0").first()
    forest = nodes.select("r", "d", "pr", "m", "v1", "v2").withColumns(
        {"tr": F.lit(root["r"] if root else None).cast("long"), "td": F.lit(0).cast("long")}
    )
    sums = centroid_rollup(forest, paths, scratch, together)
    return (
        nodes.join(sums, ["r", "d"]).join(_end_hashes(paths), ["r", "d"], "left")
        .select(
            F.col("r").alias("conv_id"), F.col("d").alias("depth"), F.col("pr").alias("parent_conv_id"),
            "n_convs", "n_children", F.col("s1").alias("n_leaves"), F.col("s2").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
