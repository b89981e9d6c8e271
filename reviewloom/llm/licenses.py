"""License notices: set phrases, and an exact set-similarity join with license templates.

A template is found where a stretch of a text holds at least ``CONTAINED`` of its distinct
words. Stretches are all runs of twice as many words as the template has, of ``LINE`` words
at least; line breaks count as spaces. The words of a template are ordered by the number of
documents that have them, rarest first. To miss the threshold by less, a stretch must have
one of the first words (prefix filter), so only the surroundings of those are looked at,
and they must have enough of the template's words in all (length filter). What passes is
verified on the sets of each stretch. Containment leaves a positional filter nothing to do.

Defined results: null text is empty and has no words and no labels; repeated rows read
alike; rows are labelled by their own text, also where they share an id or have none; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import words
from .scratch import Scratch

PHRASES: Mapping[str, str] = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Share of a template's words that a stretch must hold.
CONTAINED = 0.9
#: Words of a stretch at least, those of a line: names and years stand inside short notices.
LINE = 16
#: Rows of prefix words, of some 200 bytes each, that are sent to all tasks.
SENT = 10_000
#: First sentences of common notices: label and words.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("all-rights-reserved", "copyright all rights reserved"),
)


def _needed(size: int) -> int:
    return math.ceil(CONTAINED * size - 1e-9)


def ordered_templates(docs: DataFrame, templates=TEMPLATES) -> list[tuple[str, list[str]]]:
    """Labels and words, each template's rarest words first, by documents with the word.

    Templates are a parameter of some dozen lines; only counts of their words come back.
    """
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for _, text in templates for w in text.split()})])
    held = F.array_intersect(F.array_distinct(words(F.lower("text"))), vocabulary)
    counts = {
        r["word"]: r["count"]
        for r in docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    }
    return [
        (label, sorted(set(text.split()), key=lambda w: (counts.get(w, 0), w)))
        for label, text in templates
    ]


def _span(text: str) -> int:
    return max(2 * len(text.split()), LINE)


def _prefixes(ordered: list[tuple[str, list[str]]], templates) -> list[tuple]:
    """A row for each word of the templates' prefixes: word, template's label and words,
    number of words needed, and words of a stretch."""
    return [
        (word, label, tokens, _needed(len(tokens)), _span(text))
        for (label, tokens), (_, text) in zip(ordered, templates)
        for word in tokens[: len(tokens) - _needed(len(tokens)) + 1]
    ]


def _prefix_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The templates by the words of their prefixes, sent to all tasks up to ``SENT`` rows.

    More templates than that are joined by a shuffle, whose hot words adaptive execution splits.
    """
    schema = "word string, label string, tokens array<string>, needed int, span int"
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= SENT else table


def surroundings(w: Column, rows: list[tuple]) -> Column:
    """Of each prefix word in ``w``: the word, its place in ``around``, and ``around``, the
    words of all stretches that hold it."""
    leads = sorted({r[0] for r in rows})
    reach = max((r[4] for r in rows), default=1)
    places = F.array_compact(F.transform(w, lambda x, i: F.when(x.isin(leads), i)))
    return F.transform(
        places,
        lambda i: F.struct(
            F.get(w, i).alias("word"), F.least(i, F.lit(reach - 1)).alias("at"),
            F.slice(w, F.greatest(i - reach + 2, F.lit(1)), F.least(i, F.lit(reach - 1)) + reach).alias("around"),
        ),
    )


def similar_stretches(rows: DataFrame, prefixes: list[tuple]) -> DataFrame:
    """Stretches of (rid, near) that hold a template: rid, label, score."""
    found = (
        rows.select("rid", F.explode("near").alias("n")).select("rid", "n.*").distinct()
        .join(_prefix_table(rows.sparkSession, prefixes), "word")
        # what the template's own stretches reach
        .withColumn("first", F.greatest(F.col("at") - F.col("span") + 1, F.lit(0)))
        .withColumn("around", F.slice("around", F.col("first") + 1, F.col("at") - F.col("first") + F.col("span")))
        .filter(F.size(F.array_intersect("around", "tokens")) >= F.col("needed"))
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("around") - F.col("span") + 1, F.lit(1)))
    held = F.transform(starts, lambda s: F.size(F.array_intersect(F.slice("around", s, F.col("span")), F.col("tokens"))))
    return (
        found.withColumn("held", F.array_max(held))
        .filter("held >= needed")
        .select("rid", "label", (F.col("held") / F.size("tokens")).alias("score"))
    )


def scan_licenses(
    docs: DataFrame, templates=TEMPLATES, phrases: Mapping[str, str] = PHRASES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels,
    labels, score."""
    scratch = Scratch(docs.sparkSession, "licenses")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prefixes = _prefixes(ordered_templates(texts, templates), templates)
    # each word with a space on either side, so that places never share one
    rows = texts.select("id", words(F.lower("text")).alias("w")).select(
        "id", F.size("w").cast("long").alias("n_words"), surroundings(F.col("w"), prefixes).alias("near"),
        F.concat(F.lit(" "), F.array_join("w", "  "), F.lit(" ")).alias("line"),
    )
    marks = {p: " " + p.replace(" ", "  ") + " " for p in phrases}
    line = F.col("line")
    hit = F.lit(False)
    for mark in marks.values():
        hit = hit | F.contains(line, F.lit(mark))
    rows = rows.select("id", "n_words", "near", F.when(hit, line).otherwise("").alias("line"))
    counts, firsts, lasts, labels = [], [], [], []
    spaces = lambda c: ((F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))) / 2).cast("long")
    for phrase, label in phrases.items():
        mark = marks[phrase]
        has = F.contains(line, F.lit(mark))
        counts.append(((F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))) / len(mark)).cast("long"))
        at = F.instr(line, mark)
        firsts.append(F.when(has, spaces(F.substring(line, F.lit(1), at - 1))))
        back = F.instr(F.reverse(line), mark[::-1])
        lasts.append(F.when(has, spaces(F.substring(line, F.lit(1), F.length(line) - back - len(mark) + 1))))
        labels.append(F.when(has, label))
    base = rows.select(
        F.monotonically_increasing_id().alias("rid"), "id", "n_words", "near", sum(counts[1:], counts[0]).alias("n_base"),
        F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base"),
    )
    base = scratch.put(base)
    found = scratch.put(
        similar_stretches(base, prefixes).groupBy("rid")
        .agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    )
    return base.join(found, "rid", "left").select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))), ","
        ).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
