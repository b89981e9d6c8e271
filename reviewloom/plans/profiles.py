"""Cleaning profiles: ordered step lists, applied as one column expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import steps as s
from ..functions.lexicon import DEFAULT, Lexicons
from ..functions.segmenter import segment_with
from ..operators import lookup, phrases
from ..session import materialise

SERVING = "serving"
TRAINING = "training"


@dataclass(frozen=True)
class TableStep:
    """A step whose lexicon is a table. It gives what the step with the same entries as
    literals gives; the text comes out with single spaces between its tokens."""

    name: str
    # (frame, key, text column) to the frame with the text rewritten
    apply: Callable[[DataFrame, str, str], DataFrame]


def _drop(words: Sequence[str] | DataFrame, keep: Sequence[str], joined: bool) -> s.Step | TableStep:
    """Stop words: single tokens, or with ``joined`` all of them as compounds look."""
    if not isinstance(words, DataFrame):
        listed = [w.replace(" ", "_") for w in words] if joined else [w for w in words if " " not in w]
        return s.drop_tokens(listed, keep)
    entry = F.col(words.columns[0])
    listed = words.select((F.replace(entry, F.lit(" "), F.lit("_")) if joined else entry).alias("entry"))
    if not joined:
        listed = listed.filter(~F.contains("entry", F.lit(" ")))
    if keep:
        listed = listed.filter(~F.col("entry").isin(list(keep)))
    return TableStep("drop_tokens", lambda df, key, text: lookup.drop_tokens(df, key, text, listed))


def _map(pairs: s.Pairs | DataFrame) -> s.Step | TableStep:
    if not isinstance(pairs, DataFrame):
        return s.map_tokens(pairs)
    return TableStep("map_tokens", lambda df, key, text: lookup.map_tokens(df, key, text, pairs))


def _compounds(compounds: Sequence[str] | DataFrame) -> s.Step | TableStep:
    if not isinstance(compounds, DataFrame):
        return s.join_compounds(compounds)
    return TableStep("join_compounds", lambda df, key, text: phrases.join_compounds(df, key, text, compounds))


def _shared(lex: Lexicons, compounds: s.Step | TableStep) -> list[s.Step | TableStep]:
    return [
        s.replace_all(lex.char_to_emoji),
        s.url,
        s.mail,
        s.tag,
        s.numbered_words,
        s.sentence_marks,
        s.laughter_everywhere,
        s.replace_phrases(lex.phrases),
        s.replace_all(lex.char_to_emoji),
        s.emoji,
        s.repeats,
        s.special,
        _map(lex.abbreviations),
        compounds,
    ]


def profile(
    name: str = SERVING,
    lexicons: Lexicons = DEFAULT,
    keep_words: Sequence[str] = (),
    segmenter: Callable[[str], str] | None = None,
) -> list[s.Step | TableStep]:
    """The steps of a profile.

    ``serving`` drops stop words first, case-sensitively, and before compounds exist, so
    only single-token entries can match. ``training`` lower-cases first and drops stop
    words last, in their joined form. ``keep_words`` names stop words to spare, such as
    the polarity words among them.
    """
    compounds = segment_with(segmenter) if segmenter else _compounds(lexicons.compounds)
    shared = _shared(lexicons, compounds)
    if name == SERVING:
        return [
            s.quality_label,
            s.feature_label,
            _drop(lexicons.stopwords, keep_words, joined=False),
            s.lower,
            *shared,
        ]
    if name == TRAINING:
        return [s.lower, *shared, _drop(lexicons.stopwords, keep_words, joined=True)]
    raise ValueError(f"unknown profile {name!r}")


def _run(text: Column, steps: Sequence[s.Step], state: int) -> tuple[Column, int]:
    for step in steps:
        text = step.on(text, state)
        state = step.after(state)
    return text, state


def run_steps(text: Column, steps: Sequence[s.Step]) -> Column:
    """Apply steps one after another; a null text is an empty one."""
    return _run(s.blank_guard(text), steps, s.RAW)[0]


_KEY, _TEXT = "__clean_key", "__clean_text"


def _run_with_tables(df: DataFrame, column: str, output: str, steps: Sequence[s.Step | TableStep]) -> DataFrame:
    """Steps of both kinds. Rows are numbered in a written table; each stretch of steps up to
    a table is written once, as a table step reads its texts twice."""
    if df.isStreaming:
        raise ValueError("lexicon tables are joined in batches: clean inside a batch handler")
    keyed = materialise(df.withColumn(_KEY, F.monotonically_increasing_id()), "keyed")
    work = keyed.select(_KEY, s.blank_guard(F.col(column)).alias(_TEXT))
    state, waiting = s.RAW, []
    for step in steps:
        if isinstance(step, TableStep):
            text, state = _run(F.col(_TEXT), waiting, state)
            work = step.apply(materialise(work.withColumn(_TEXT, text), "cleaning"), _KEY, _TEXT)
            state, waiting = s.SPACED, []
        else:
            waiting.append(step)
    text, _ = _run(F.col(_TEXT), waiting, state)
    cleaned = work.select(_KEY, text.alias(_TEXT))
    named = [x for x in df.columns if x != output]
    return keyed.join(cleaned, _KEY).select(*named, F.col(_TEXT).alias(output))


def clean(
    df: DataFrame,
    column: str,
    output: str = "processed_comment",
    name: str = SERVING,
    lexicons: Lexicons = DEFAULT,
    keep_words: Sequence[str] = (),
    segmenter: Callable[[str], str] | None = None,
) -> DataFrame:
    """Clean a text column with a whole profile. Lexicons that are tables are joined, the
    others are part of the expression; the result is the same."""
    steps = profile(name, lexicons, keep_words, segmenter)
    if any(isinstance(step, TableStep) for step in steps):
        return _run_with_tables(df, column, output, steps)
    return df.withColumn(output, run_steps(F.col(column), steps))
