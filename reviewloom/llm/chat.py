"""Chat formatting after collapsing cumulative snapshots of conversations.

A log that writes a conversation again after each turn holds many conversations that are
the beginning of a longer one. Each turn has a 128-bit hash of its number, role and text;
a running XOR over a conversation's turns is the rolling hash of each of its prefixes. A
conversation whose last rolling hash is that of a proper prefix of another one goes, by an
anti-join; of equal conversations the smallest id stays. The rest is rendered.

A conversation may be of any length: rolling hashes are made in blocks of turn numbers, a
block's start being the XOR of the blocks before it, and each rendered row holds the turns
of one block.

Defined results: rows that repeat a turn count once; turns with one number keep the order
of role, then text, nulls first; null role renders as ``unknown``, null text as empty;
turns without a number come first; rows without a conversation id go; an empty table gives
no rows; other columns are not read. What opens and closes a mark of the template is written
with a space inside where it stands in a role or text, so that no turn can forge another. A
null role and the role ``unknown``, or null and empty text, read alike and are told apart: the
conversations stay two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: Turn numbers of a block.
BLOCK = 64
TEMPLATE = "<|{role}|>\n{text}\n<|end|>\n"
#: What marks are made of, and how it is written inside a role or a text.
MARKS = (("<|", "< |"), ("|>", "| >"))


def escaped(text: Column) -> Column:
    """The text without marks; one pass each leaves none, as what is put in holds none."""
    for mark, written in MARKS:
        text = F.replace(text, F.lit(mark), F.lit(written))
    return text


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    key = [F.col(x).alias(y) for x, y in ((conv, "conv"), (turn, "turn"), (role, "role"), (text, "text"))]
    return (
        conversations.select(*key).filter("conv is not null").distinct()
        .withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK))
        .withColumn("h1", F.xxhash64(F.lit(1), "turn", F.col("role").isNull(), "role", F.col("text").isNull(), "text"))
        .withColumn("h2", F.xxhash64("text", F.col("text").isNull(), "role", F.col("role").isNull(), "turn", F.lit(2)))
    )


def maximal_conversations(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, n_turns, kept, keep_id) of all conversations."""
    ordered = scratch.put(turns.select("conv", "turn", "block", "h1", "h2"))
    blocks = ordered.groupBy("conv", "block").agg(
        F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2")
    )
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col("conv").alias("c"), F.col("block").alias("b"),
        F.coalesce(F.bit_xor("b1").over(before), F.lit(0)).alias("s1"),
        F.coalesce(F.bit_xor("b2").over(before), F.lit(0)).alias("s2"),
    )
    # turns of one number belong together: a prefix ends with a number, not inside one
    steps = ordered.groupBy("conv", "block", "turn").agg(
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.count(F.lit(1)).alias("n")
    )
    inside = Window.partitionBy("conv", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = scratch.put(
        steps.withColumn("r1", F.bit_xor("h1").over(inside)).withColumn("r2", F.bit_xor("h2").over(inside))
        .join(starts, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("b")))
        .select(
            "conv", "turn", "n",
            F.col("r1").bitwiseXOR(F.col("s1")).alias("p1"), F.col("r2").bitwiseXOR(F.col("s2")).alias("p2"),
        )
    )
    ends = prefixes.groupBy("conv").agg(
        F.max(F.struct(F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"), "p1", "p2")).alias("end"),
        F.sum("n").alias("n_turns"),
    )
    ends = scratch.put(ends.select("conv", "n_turns", F.col("end.turn").alias("last"), "end.p1", "end.p2"))
    inner = (
        prefixes.join(ends.select("conv", "last"), "conv")
        .filter(F.coalesce("turn", F.lit(-(1 << 62))) < F.col("last"))
        .select("p1", "p2").distinct()
    )
    classes = ends.groupBy("p1", "p2").agg(F.min("conv").alias("keep_id"))
    longest = scratch.put(classes.join(inner, ["p1", "p2"], "left_anti").select("keep_id"))
    return ends.join(longest, F.col("conv") == F.col("keep_id"), "left").select(
        "conv", "n_turns", F.col("keep_id").isNotNull().alias("kept")
    )


def format_chats(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The kept conversations, rendered: id, part (block of turns), n_turns, rendered."""
    scratch = Scratch(conversations.sparkSession, "chat")
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    kept = maximal_conversations(turns, scratch).filter("kept").select(F.col("conv").alias("c"))
    head, rest = TEMPLATE.split("{role}")
    middle, tail = rest.split("{text}")
    rendered = F.concat(
        F.lit(head), escaped(F.coalesce("role", F.lit("unknown"))), F.lit(middle),
        escaped(F.coalesce("text", F.lit(""))), F.lit(tail),
    )
    return (
        turns.join(kept, F.col("conv") == F.col("c"), "left_semi")
        .groupBy("conv", "block")
        .agg(
            F.count(F.lit(1)).alias("n_turns"),
            F.array_join(
                F.transform(
                    F.sort_array(F.collect_list(F.struct("turn", "role", "text", rendered.alias("rendered")))),
                    lambda x: x["rendered"],
                ),
                "",
            ).alias("rendered"),
        )
        .select(F.col("conv").alias(conv_col), F.col("block").alias("part"), "n_turns", "rendered")
    )
