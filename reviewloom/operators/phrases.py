"""Phrase lexicons of any size, as tables: the longest phrase from the left wins.

Phrases are indexed by their first token, with the lengths of the phrases that begin with
it. The distinct tokens of a text that begin a phrase are found by one join; at each place of
such a token all lengths are cut out of the text, and the distinct runs are probed by a second
join. One ordered pass over the text then takes at each place the longest hit, and goes on
behind it. A place costs as much as its token has lengths, so a long text takes time in
proportion, and what a text repeats crosses a shuffle once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import steps as s
from .lookup import distinct_tokens, spaced

_WORD, _HEADS, _LENGTHS, _PHRASE, _VALUE, _SIZE, _HITS = (
    "__word", "__heads", "__lengths", "__phrase", "__value", "__size", "__hits"
)


def phrase_table(phrases: DataFrame) -> DataFrame:
    """``key, value`` rows to one row for each phrase of tokens; of rows that read alike the
    smallest value counts, rows without a token or a value go."""
    words = s.token_array(F.col("key"))
    return (
        phrases.select(words.alias(_WORD), F.col("value").alias(_VALUE))
        .filter((F.size(_WORD) > 0) & F.col(_VALUE).isNotNull())
        .groupBy(F.array_join(_WORD, " ").alias(_PHRASE), F.size(_WORD).alias(_SIZE), F.col(_WORD)[0].alias(_WORD))
        .agg(F.min(_VALUE).alias(_VALUE))
    )


@F.pandas_udf(T.ArrayType(T.StringType()))
def _runs(texts: pd.Series, heads: pd.Series, lengths: pd.Series) -> pd.Series:
    """The distinct runs of tokens that begin with a head and have one of its lengths."""

    def one(text: str, heads, lengths) -> list[str]:
        words, get = text.split(" "), dict(zip(heads, lengths, strict=True)).get
        return list({
            " ".join(words[i : i + n]) for i, w in enumerate(words) for n in get(w, ()) if i + n <= len(words)
        })

    return pd.Series([one(*x) for x in zip(texts, heads, lengths, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def _scanned(texts: pd.Series, phrases: pd.Series, values: pd.Series) -> pd.Series:
    """The texts with the phrases found in them replaced, in one ordered scan: array functions
    have no linear form for one that goes on behind what it took."""

    def one(text: str | None, phrases, values) -> str | None:
        if text is None or phrases is None:
            return text
        table, lengths = dict(zip(phrases, values, strict=True)), {}
        for phrase in table:
            lengths.setdefault(phrase.partition(" ")[0], set()).add(phrase.count(" ") + 1)
        longest_first = {w: sorted(n, reverse=True) for w, n in lengths.items()}
        words, out, at = text.split(" "), [], 0
        while at < len(words):
            for n in longest_first.get(words[at], ()):
                value = table.get(" ".join(words[at : at + n])) if at + n <= len(words) else None
                if value is not None:
                    out.append(value)
                    at += n
                    break
            else:
                out.append(words[at])
                at += 1
        return " ".join(out)

    return pd.Series([one(*x) for x in zip(texts, phrases, values, strict=True)], dtype=object)


def phrase_hits(df: DataFrame, key: str, text: str, phrases: DataFrame) -> DataFrame:
    """Per text with a hit: ``__hits``, an array of (phrase, value), each phrase in it once,
    also those that the scan passes over. ``phrases`` comes from ``phrase_table``."""
    heads = phrases.groupBy(_WORD).agg(F.collect_set(_SIZE).alias(_LENGTHS))
    begun = (
        distinct_tokens(df, key, text, _WORD).join(heads, _WORD)
        .groupBy(key).agg(F.collect_list(F.struct(_WORD, _LENGTHS)).alias(_HEADS))
    )
    runs = _runs(_WORD, F.col(_HEADS)[_WORD], F.col(_HEADS)[_LENGTHS])
    probes = (
        df.select(key, spaced(text).alias(_WORD)).join(begun, key)
        .select(key, F.explode(runs).alias(_PHRASE))
    )
    return (
        probes.join(phrases.select(_PHRASE, _VALUE), _PHRASE)
        .groupBy(key).agg(F.collect_list(F.struct(F.col(_PHRASE).alias("phrase"), F.col(_VALUE).alias("value"))).alias(_HITS))
    )


def map_phrases(
    df: DataFrame, key: str, text: str, dictionary: DataFrame, output: str | None = None
) -> DataFrame:
    """Replace phrases of whole tokens through a ``key, value`` table. Values are not looked
    at again. Tokens come out separated by single spaces; ``key`` must be unique."""
    hits = phrase_hits(df, key, text, phrase_table(dictionary))
    scanned = _scanned(spaced(text), F.col(_HITS)["phrase"], F.col(_HITS)["value"])
    return df.join(hits, key, "left").withColumn(output or text, s.squeeze(scanned)).drop(_HITS)


def join_compounds(
    df: DataFrame, key: str, text: str, compounds: DataFrame, output: str | None = None
) -> DataFrame:
    """Join the tokens of the phrases in the first column with ``_``."""
    phrase = F.array_join(s.token_array(F.col(compounds.columns[0])), " ")
    table = compounds.select(phrase.alias("key")).filter(F.contains("key", F.lit(" ")))
    return map_phrases(df, key, text, table.withColumn("value", F.replace("key", F.lit(" "), F.lit("_"))), output)
