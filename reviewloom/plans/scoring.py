"""Raw messages to scored messages: one stateless chain of projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records as r
from ..functions.lexicon import DEFAULT, Lexicons
from ..functions.score import sentiment
from .profiles import SERVING, clean

RESULT_COLUMNS = tuple(r.RESULT_MESSAGE.names)


def score_messages(
    messages: DataFrame,
    value: str = "value",
    lexicons: Lexicons = DEFAULT,
    keep_words: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse, clean and score JSON messages, batch or stream.

    Returns the result columns and, before them, the input columns named in ``keep``.
    """
    parsed = messages.select(
        *keep, r.parse(r.decode(F.col(value)), r.SCORED_FIELDS).alias("m")
    )
    flat = parsed.select(
        *keep,
        F.col("m.rating").alias("rating"),
        F.col("m.comment").alias("original_comment"),
        F.col("m.time").alias("time"),
    )
    cleaned = clean(flat, "original_comment", "processed_comment", SERVING, lexicons, keep_words)
    return cleaned.withColumn("sentiment", sentiment(F.col("processed_comment"))).select(
        *keep, *RESULT_COLUMNS
    )


def to_result_value(scored: DataFrame) -> DataFrame:
    """Scored rows as the JSON ``value`` that goes to the result topic."""
    return scored.select(r.emit(*RESULT_COLUMNS).alias("value"))


def read_results(results: DataFrame, value: str = "value") -> DataFrame:
    """Result messages to columns; empty messages are skipped."""
    return (
        results.select(r.decode(F.col(value)).alias("value"))
        .filter(F.col("value") != "")
        .select(r.parse(F.col("value"), r.RESULT_READ).alias("data"))
        .select("data.*")
    )
