"""Benchmark passages in documents, by a positional inverted index.

A window is ten consecutive words of a benchmark item (all words of a shorter item). The
documents are read once into postings (term, document, position) of every benchmark term,
stored as a table. Document counts of the terms come from the postings. Of each window the
rarest terms lead the search: the postings of the rarest, moved back by its offset in the
window, are the places where the window could start; they are intersected with the moved
postings of the second rarest. What is left is compared word by word with the document.

Index and comparison lower-case A-Z alone.

Defined results: null text has no words; an item without words is never found; rows of the
benchmark that repeat, or share an id, count once; items without an id mark words as hit
but are not listed; rows of documents that share an id, or have none, are told apart by a hash
of their text and have hits of their own; empty tables give no hits or no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

WINDOW = 10
#: Terms of a window whose postings are intersected.
LEADING = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words once A-Z are lower-cased, and before.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATOR_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column, separator: str = SEPARATOR) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def row_key(id_col: str, text_col: str) -> Column:
    """What tells documents apart, also where they share an id."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text"))


def benchmark_windows(benchmark: DataFrame, scratch: Scratch, id_col: str, text_col: str, size: int):
    """Distinct windows (w, phrase, len, terms) and the items (w, item) that have them."""
    found = (
        benchmark.select(F.col(id_col).alias("item"), words(ascii_lower(F.col(text_col))).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("len", F.least(F.size("words"), F.lit(size)))
        .select("item", "len", "words", F.explode(F.expr("sequence(1, size(words) - len + 1)")).alias("at"))
        .select("item", F.array_join(F.expr("slice(words, at, len)"), " ").alias("phrase"))
    )
    found = scratch.put(found.distinct())
    windows = scratch.put(
        found.select("phrase").distinct()
        .select(
            F.monotonically_increasing_id().alias("w"), "phrase",
            F.size(F.split("phrase", " ")).alias("len"),
        )
    )
    items = scratch.put(
        found.filter("item is not null").join(windows, "phrase").select("w", "item").distinct()
    )
    return windows, items


def build_index(docs: DataFrame, vocabulary: DataFrame, scratch: Scratch) -> DataFrame:
    """Postings (t, id, pos) of the terms in ``vocabulary`` (t, term); pos counts from 0."""
    return scratch.put(
        docs.select("id", F.posexplode(words(ascii_lower(F.col("text")))).alias("pos", "term"))
        .join(vocabulary, "term")
        .select("t", "id", "pos")
    )


def leading_terms(windows: DataFrame, vocabulary: DataFrame, postings: DataFrame, n: int) -> DataFrame:
    """The ``n`` rarest terms of each window: w, rank, t, offset. Windows with a term that
    no document has are left out."""
    counts = postings.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    terms = (
        windows.select("w", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
        .join(vocabulary, "term")
        .join(counts, "t", "left")
    )
    by_window = Window.partitionBy("w")
    return (
        terms.withColumn("known", F.count("df").over(by_window) == F.count(F.lit(1)).over(by_window))
        .withColumn("rank", F.row_number().over(by_window.orderBy("df", "t", "offset")))
        .filter(F.col("known") & (F.col("rank") <= n))
        .select("w", "rank", "t", "offset")
    )


def intersect(postings: DataFrame, leading: DataFrame, n: int, slack: int = 0) -> DataFrame:
    """Places (w, id, start) where the leading terms of a window all stand, each at most
    ``slack`` words away from its place in the window."""
    found = (
        postings.join(leading.filter("rank = 1"), "t")
        .select("w", "id", (F.col("pos") - F.col("offset")).alias("start"))
        .filter("start >= 0" if not slack else "true")
    )
    for rank in range(2, n + 1):
        own = leading.filter(F.col("rank") == rank).select("w", "t", F.col("offset").alias("o"))
        wanted = found.join(own, "w", "left").withColumn("at", F.col("start") + F.col("o"))
        there = postings.join(own.select("t").distinct(), "t", "left_semi").select(
            F.col("t").alias("t2"), F.col("id").alias("id2"), F.col("pos").alias("pos2")
        )
        if slack:
            near = wanted.withColumn("at", F.explode(F.expr(f"sequence(at - {slack}, at + {slack})")))
        else:
            near = wanted
        # a window of fewer words than leading terms has nothing left to intersect
        found = (
            near.filter("t is not null")
            .join(
                there,
                (F.col("t") == F.col("t2")) & F.col("id").eqNullSafe(F.col("id2")) & (F.col("at") == F.col("pos2")),
                "left_semi",
            )
            .select("w", "id", "start")
            .union(wanted.filter("t is null").select("w", "id", "start"))
        )
        if slack:
            found = found.distinct()
    return found


def _prepared(docs, benchmark, scratch, id_col, text_col, item_col, item_text_col, size):
    texts = docs.select(row_key(id_col, text_col).alias("id"), F.col(text_col).alias("text"))
    windows, items = benchmark_windows(benchmark, scratch, item_col, item_text_col, size)
    vocabulary = scratch.put(
        windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
        .withColumn("t", F.monotonically_increasing_id())
    )
    postings = build_index(texts, vocabulary, scratch)
    leading = scratch.put(leading_terms(windows, vocabulary, postings, LEADING))
    return texts, windows, items, postings, leading


def occurrences(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, id_col="doc_id", text_col="text",
    item_col="item_id", item_text_col="text", size: int = WINDOW,
) -> tuple[DataFrame, DataFrame]:
    """All exact occurrences (id, w, start, len) of windows, and the windows' items."""
    texts, windows, items, postings, leading = _prepared(
        docs, benchmark, scratch, id_col, text_col, item_col, item_text_col, size
    )
    places = scratch.put(intersect(postings, leading, LEADING))
    scratch.drop(postings)
    by_doc = (
        places.join(windows, "w")
        .groupBy(F.col("id").alias("own_id"))
        .agg(F.collect_set(F.struct("w", "start", "len", "phrase")).alias("places"))
    )
    # places are compared inside the row, so its words are not copied for each of them
    stands = F.filter(
        "places",
        lambda p: F.array_join(F.slice(F.col("words"), p["start"] + 1, p["len"]), " ") == p["phrase"],
    )
    exact = (
        texts.join(by_doc, F.col("id").eqNullSafe(F.col("own_id")))
        .select("id", words(ascii_lower(F.col("text"))).alias("words"), "places")
        .select("id", F.explode(stands).alias("p"))
        .select("id", "p.w", "p.start", "p.len")
        .distinct()
    )
    return scratch.put(exact), items


def proximity_matches(
    docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text",
    item_col="item_id", item_text_col="text", size: int = WINDOW, slack: int = 3,
) -> DataFrame:
    """Looser matches: documents where a window's rarest terms stand within ``slack`` words
    of their places: id, item, start (where the window would begin), phrase."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    _, windows, items, postings, leading = _prepared(
        docs, benchmark, scratch, id_col, text_col, item_col, item_text_col, size
    )
    return (
        intersect(postings, leading, LEADING, slack)
        .join(windows, "w").join(items, "w")
        .select(F.col("id.id").alias(id_col), F.col("item").alias(item_col), "start", "phrase")
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text",
    item_col="item_id", item_text_col="text", size: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    found, items = occurrences(
        docs, benchmark, scratch, id_col, text_col, item_col, item_text_col, size
    )
    # The union of the hit stretches: each adds what reaches beyond all that begin before it.
    stretches = found.groupBy("id", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy("id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    hit = (
        stretches.withColumn("covered", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy(F.col("id").alias("hit_id"))
        .agg(
            F.sum(
                F.greatest(F.lit(0), F.col("end") - F.greatest("start", "covered"))
            ).cast("long").alias("n_hit")
        )
    )
    listed = (
        found.select("id", "w").distinct().join(items, "w").select("id", "item").distinct()
        .groupBy(F.col("id").alias("list_id"))
        .agg(F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"))
    )
    return (
        docs.select(
            row_key(id_col, text_col).alias("id"),
            F.size(words(F.col(text_col), SEPARATOR_ANY_CASE)).cast("long").alias("n_words"),
        )
        .join(hit, F.col("id").eqNullSafe(F.col("hit_id")), "left")
        .join(listed, F.col("id").eqNullSafe(F.col("list_id")), "left")
        .select(
            F.col("id.id").alias(id_col),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
