"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links`` (a, b) to (v, component): the smallest vertex that v reaches.

    Rounds of contraction: each vertex moves to the neighbour, or itself, that is first
    in a pseudo-random order, and links are renamed accordingly, until none is left. The
    order keeps chains short, so the rounds grow with the logarithm of the graph. Two rounds
    go by one order: in the first the first of a vertex's neighbours takes its links, in the
    second all of them follow, so many vertices around one are done with in two rounds.
    """
    edges = scratch.put(links.filter("a <> b").select("a", "b").distinct())
    labels = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct()
    labels = labels.withColumn("l", F.col("v"))
    round_ = 0
    while not edges.isEmpty():
        round_ += 1
        both = edges.union(edges.select("b", "a")).toDF("u", "w")
        order = lambda c: F.struct(F.xxhash64(c, F.lit((round_ + 1) // 2)).alias("h"), c.alias("v"))  # noqa: B023, E731
        moved = scratch.put(
            both.groupBy("u")
            .agg(F.min(order(F.col("w"))).alias("best"))
            .select("u", F.least(F.col("best"), order(F.col("u"))).getField("v").alias("to"))
        )
        # written in each round, so that no plan, nor the code made for it, holds all rounds
        labels = scratch.put(
            labels.join(moved.toDF("l", "to"), "l", "left").select("v", F.coalesce("to", "l").alias("l"))
        )
        edges = scratch.put(
            edges.join(moved.toDF("a", "to_a"), "a")
            .join(moved.toDF("b", "to_b"), "b")
            .filter("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct()
        )
    if not round_:
        labels = scratch.put(labels)
    least = labels.groupBy("l").agg(F.min("v").alias("component"))
    return scratch.put(labels.join(least, "l").select("v", "component"))
