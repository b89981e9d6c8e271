"""Lexicon sentiment score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import NEGATIVE, POSITIVE
from .steps import bind, tokens, trim_blank


def _hits(text: Column, words: Sequence[str], mode: str) -> Column:
    if mode == "substring":
        found = [F.contains(text, F.lit(w)) for w in words]
    elif mode == "token":
        listed = tokens(text)
        return F.size(F.array_intersect(listed, F.array(*map(F.lit, words))))
    else:
        raise ValueError(f"mode is 'substring' or 'token', not {mode!r}")
    return reduce(lambda a, b: a + b, (f.cast("int") for f in found))


def sentiment(
    text: Column,
    positive: Sequence[str] = POSITIVE,
    negative: Sequence[str] = NEGATIVE,
    mode: str = "substring",
) -> Column:
    """1 positive, 0 negative, -1 for null or blank text.

    Each word counts once if it occurs at all; a tie, also without any hit, is 1. With
    ``mode="token"`` a word must be a whole token instead of any part of the text.
    """

    def score(low: Column) -> Column:
        return (
            F.when(low.isNull() | (trim_blank(low) == ""), F.lit(-1))
            .when(_hits(low, negative, mode) > _hits(low, positive, mode), F.lit(0))
            .otherwise(F.lit(1))
        )

    return bind(F.lower(text), score).cast("int")
