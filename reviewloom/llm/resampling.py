"""Importance resampling towards a target: documents drawn by hashed n-gram gains.

A text's features are its words and pairs of neighbouring words, hashed into buckets. The
gain of a bucket is the logarithm of its share in the target texts over its share in all
documents; a document's weight is the mean gain of its features. A Gumbel number from a hash
of the id is added, so the documents of the highest scores are a draw without replacement
in proportion to the exponential of the weights.

Two passes over the documents. Each works on stretches of texts: n-grams are interned in an
open-addressed table (``ngram_table``), so a checksum is taken once for each distinct n-gram;
the first pass adds the slots' counts up by bucket, the second one gathers the slots' gains at
the places of each document. Between them is one table with a row for each bucket, the
only thing that is broadcast. Ranks come from ranges of the score.

Defined results: null, empty and blank texts have no features and weight 0; rows that repeat an
id are scored each for itself, with the same random part; rows without an id hash the bare
seed and lose ties; with an empty target or no documents the shares are those of the added ones; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram_table import features
from .ordering import numbered
from .scratch import Scratch, bounded_batches

BUCKETS = 10_000
#: Gains and random parts are counted in thousandths.
SCALE = 1000
MIN_WORDS = 20
SHARE = 25
SEED = 7


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, n_buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the features of a table with the one column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, dtype=np.int64)
        for batch in batches:
            for _, _, table in features(_texts(batch.column(0)), n_buckets):
                np.add.at(total, table.buckets[table.used], table.counts[table.used])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], n_buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, a whole number of thousandths."""
    all_s, all_t = sum(source.values()), sum(target.values())
    return np.array([
        math.floor(
            SCALE * math.log(
                (float(target.get(b, 0)) + 1) * (float(all_s) + n_buckets)
                / ((float(source.get(b, 0)) + 1) * (float(all_t) + n_buckets))
            )
        )
        for b in range(n_buckets)
    ], dtype=np.int64)


def _weigh(shared, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.frombuffer(shared.value, dtype=np.int64)
        for batch in batches:
            texts = _texts(batch.column("text"))
            n = np.zeros(len(texts), dtype=np.int64)
            words, total = n.copy(), n.copy()
            for text_of, single, table in features(texts, n_buckets):
                own = gain[table.buckets][table.slots]
                n += np.bincount(text_of, minlength=len(texts))
                words += np.bincount(text_of[single], minlength=len(texts))
                np.add.at(total, text_of, own)
            weight = np.floor_divide(total, np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n), pa.array(words), pa.array(weight)],
                names=["id", "n_features", "n_words", "weight"],
            )

    return run


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    n_buckets: int = BUCKETS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_features, weight, score, rank.

    Of the documents with at least ``min_words`` words, ``share`` per cent are drawn; ``rank``
    counts them from the highest score, and is null for the others.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "resampling")
    # a row for each bucket, whatever the size of the tables
    source, aim = (
        {r["bucket"]: r["n"] for r in bucket_counts(t, n_buckets).collect()}
        for t in (docs.select(F.col(text_col).alias("text")), target.select(F.col(target_text_col).alias("text")))
    )
    shared = spark.sparkContext.broadcast(gains(source, aim, n_buckets).tobytes())
    id_type = docs.schema[id_col].dataType.simpleString()
    draw = F.conv(
        F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8),
        16, 10,
    ).cast("long")
    gumbel = F.floor(-SCALE * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = scratch.put(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(_weigh(shared, n_buckets), f"id {id_type}, n_features long, n_words long, weight long")
        .withColumn("score", F.col("weight") + gumbel)
    )
    able = scored.filter(F.col("n_words") >= min_words)
    drawn = share * able.count() // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features")]
    ranked = numbered(able, order, "rank", scratch).withColumn(
        "rank", F.when(F.col("rank") < drawn, F.col("rank") + 1)
    )
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.union(rest.select(ranked.columns)).select(
        F.col("id").alias(id_col), "n_features", "weight", "score", "rank"
    )
