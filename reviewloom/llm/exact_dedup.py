"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of characters. The distinct blocks are sorted
and numbered; equal blocks get one integer name. Then adjacent names are paired, the
distinct pairs are sorted and numbered in turn, and so on until each document has one
name. Two documents have the same name (and the same number of rounds) if and only if
their texts are equal: names stand for texts, not for their hashes.

Block texts cross the network once, to be made distinct. A 64-bit fingerprint leads a
block to its name where the fingerprint has one text, which the naming step checks;
should two texts ever share a fingerprint, the blocks are joined by their text.

Defined results: null text counts as empty and all empty texts are equal; of equal texts
the longest original stays, then the smallest id, null ids last, and of repeated rows
just one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Characters of a block.
BLOCK = 4096
#: The second half of a pair that has none.
NONE = -1
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def blocks_of(text: Column, size: int) -> Column:
    """The blocks in order; an empty text is one empty block."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(found)


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Sorted within each partition and numbered; the partition is the number's prefix."""
    return distinct.sortWithinPartitions(*order).withColumn(
        "name", F.monotonically_increasing_id()
    )


def named_documents(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    fingerprint: Callable[[Column], Column] = F.xxhash64,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: rid, id, n_chars, text_sha256, the columns to carry
    along, level, name."""
    texts = docs.select(
        *carry,
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"),
        normalised(F.col(text_col)).alias("norm"),
    )
    cut = texts.withColumn("blocks", blocks_of(F.col("norm"), block))
    # One set of texts for each fingerprint, combined ahead of the shuffle.
    sets = (
        cut.select(F.explode("blocks").alias("block"))
        .groupBy(fingerprint(F.col("block")).alias("key"))
        .agg(F.sort_array(F.collect_set("block")).alias("texts"))
    )
    names = scratch.put(
        _numbered(
            sets.select(
                "key", (F.size("texts") > 1).alias("shared"), F.explode("texts").alias("block")
            ),
            "key",
            "block",
        ).select("key", "name", "shared", F.when(F.col("shared"), F.col("block")).alias("block"))
    )
    clash = not names.filter("shared").isEmpty()
    fields = [
        F.monotonically_increasing_id().alias("rid"),
        "id",
        "n_chars",
        *carry,
        F.sha2(F.col("norm"), 256).alias("text_sha256"),
        F.transform("blocks", lambda b: fingerprint(b)).alias("keys"),
    ]
    base = scratch.put(cut.select(*fields, *(["blocks"] if clash else [])))
    n = F.size("keys").alias("n")
    if clash:
        placed = base.select("rid", n, F.posexplode(F.arrays_zip("keys", "blocks"))).select(
            "rid", "n", F.col("pos").alias("i"), F.col("col.keys").alias("key"),
            F.col("col.blocks").alias("block"),
        )
        by_text = placed.join(
            names.filter("shared").select("key", "block", "name"), ["key", "block"]
        )
        by_key = placed.join(names.filter("not shared").select("key", "name"), "key")
        level = by_key.select("rid", "n", "i", "name").union(
            by_text.select("rid", "n", "i", "name")
        )
    else:
        placed = base.select("rid", n, F.posexplode("keys").alias("i", "key"))
        level = placed.join(names.select("key", "name"), "key").select("rid", "n", "i", "name")

    level = scratch.put(level)
    done = [level.filter("n = 1").select("rid", F.lit(0).alias("level"), "name")]
    most = level.agg(F.max("n")).first()[0] or 0
    rounds = 0
    while most > 1:
        rounds += 1
        pairs = scratch.put(
            level.filter("n > 1")
            .groupBy("rid", F.floor(F.col("i") / 2).cast("int").alias("i"))
            .agg(
                F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(NONE)).alias("b"),
                F.ceil(F.max("n") / 2).cast("int").alias("n"),
            )
        )
        pair_names = scratch.put(_numbered(pairs.select("a", "b").distinct(), "a", "b"))
        level = scratch.put(pairs.join(pair_names, ["a", "b"]).select("rid", "n", "i", "name"))
        scratch.drop(pairs, pair_names)
        done.append(level.filter("n = 1").select("rid", F.lit(rounds).alias("level"), "name"))
        most = -(-most // 2)
    identity = done[0]
    for more in done[1:]:
        identity = identity.union(more)
    return base.select("rid", "id", "n_chars", "text_sha256", *carry).join(identity, "rid")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    fingerprint: Callable[[Column], Column] = F.xxhash64,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, and the
    columns to carry along."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    named = scratch.put(named_documents(docs, scratch, id_col, text_col, block, fingerprint, carry))
    first = F.min(
        F.struct(
            (-F.col("n_chars")).alias("longest"), F.col("id").isNull().alias("unknown"), "id", "rid"
        )
    )
    # Written, so that the join reads it as it is and can split a large group.
    groups = scratch.put(
        named.groupBy("level", "name").agg(
            F.count(F.lit(1)).alias("group_size"), first.alias("first")
        )
    )
    return named.join(groups, ["level", "name"]).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"),
        "text_sha256",
        *carry,
    )
