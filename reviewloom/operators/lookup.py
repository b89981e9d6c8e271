"""Lexicons too large to be literals, joined as tables.

The distinct tokens of a text meet the lexicon, and those found in it come back with their
values, grouped per text. A text is then rebuilt in one pass over its tokens, which looks each
one up among its own hits, so the work on a long text grows with its tokens and not with tokens
times hits, and a token that a text repeats crosses a shuffle once. A lexicon is not repeated
for a salted join, as it may be as large as the texts; a token that occurs in most texts is
split by adaptive execution.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import steps as s
from ..session import materialise

_WORD, _VALUE, _ORD, _HITS = "__word", "__value", "__ord", "__hits"


def spaced(text: str) -> Column:
    """The tokens of a text with single spaces between them; null stays null."""
    return F.array_join(s.token_array(F.col(text)), " ")


def distinct_tokens(df: DataFrame, key: str, text: str, output: str) -> DataFrame:
    """``key, output``: each token of a text once."""
    return df.select(key, F.explode(F.array_distinct(s.token_array(F.col(text)))).alias(output))


def _found(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Per text the tokens found: ``__hits``, an array of (word, value)."""
    found = distinct_tokens(df, key, text, _WORD).join(lexicon, _WORD)
    hit = F.struct(F.col(_WORD).alias("word"), F.col(_VALUE).alias("value"))
    return found.groupBy(key).agg(F.collect_list(hit).alias(_HITS))


@F.pandas_udf(T.StringType())
def _rebuilt(texts: pd.Series, words: pd.Series, values: pd.Series) -> pd.Series:
    """The tokens, each one found with its value instead; a null value drops it."""

    def one(text: str | None, words, values) -> str | None:
        if text is None or words is None:
            return text
        get = dict(zip(words, values, strict=True)).get
        return " ".join([v for w in text.split(" ") if (v := get(w, w)) is not None])

    return pd.Series([one(*x) for x in zip(texts, words, values, strict=True)], dtype=object)


def resolve_chains(dictionary: DataFrame) -> DataFrame:
    """``ord, key, value`` rows to one ``key, value`` row per key, with chains followed.

    A token takes the value of its first row, and goes on with the first later row whose
    key is that value. So each row, known by its ``ord`` and key, has at most one next
    row; the steps double in each round, and a chain of n rows takes log2(n) rounds. Of
    rows alike in both the smallest value counts.
    """
    rows = (
        dictionary.groupBy(F.col("ord").alias(_ORD), F.col("key").alias(_WORD))
        .agg(F.min("value").alias(_VALUE))
    )
    later = rows.select(F.col(_ORD).alias("__next"), F.col(_WORD).alias("__key"))
    follows = (
        rows.join(later, (F.col(_VALUE) == F.col("__key")) & (F.col("__next") > F.col(_ORD)))
        .groupBy(_ORD, _WORD).agg(F.min(F.struct("__next", "__key")).alias("__to"))
    )
    itself = F.struct(F.col(_ORD).alias("__next"), F.col(_WORD).alias("__key"))
    reached = materialise(
        rows.join(follows, [_ORD, _WORD], "left")
        .select(_ORD, _WORD, F.coalesce("__to", itself).alias("__end")),
        "chains",
    )
    while True:
        further = reached.select(itself.alias("__end"), F.col("__end").alias("__further"))
        moved = materialise(reached.join(further, "__end"), "chains")
        reached = moved.select(_ORD, _WORD, F.col("__further").alias("__end"))
        if moved.filter("__end <> __further").isEmpty():
            break
    first = rows.groupBy(_WORD).agg(F.min(_ORD).alias(_ORD))
    last = rows.select(itself.alias("__end"), _VALUE)
    return first.join(reached, [_ORD, _WORD]).join(last, "__end").select(_WORD, _VALUE)


def _replace(df: DataFrame, key: str, text: str, lexicon: DataFrame, output: str, finish) -> DataFrame:
    hits = _found(df, key, text, lexicon)
    rebuilt = _rebuilt(spaced(text), F.col(_HITS)["word"], F.col(_HITS)["value"])
    return df.join(hits, key, "left").withColumn(output, finish(rebuilt)).drop(_HITS)


def map_tokens(
    df: DataFrame, key: str, text: str, dictionary: DataFrame, output: str | None = None
) -> DataFrame:
    """Replace whole tokens through a dictionary table. ``key`` must be unique."""
    # a null value keeps its token
    resolved = resolve_chains(dictionary).filter(F.col(_VALUE).isNotNull())
    return _replace(df, key, text, resolved, output or text, s.squeeze)


def drop_tokens(
    df: DataFrame, key: str, text: str, words: DataFrame, output: str | None = None
) -> DataFrame:
    """Drop tokens that are in the first column of ``words``. ``key`` must be unique."""
    listed = words.select(F.col(words.columns[0]).alias(_WORD)).distinct()
    dropped = listed.withColumn(_VALUE, F.lit(None).cast("string"))
    return _replace(df, key, text, dropped, output or text, lambda x: x)
