"""Concatenation, de-duplication, order and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedupe, ingest
from . import views
from .registry import Catalog, Tables

CATALOG = Catalog()


@CATALOG.query(
    """
SELECT 'documents' AS split, doc_id AS id, text FROM documents
UNION ALL SELECT 'conversations', conv_id, text FROM conversations
UNION ALL SELECT 'benchmark', item_id, text FROM benchmark
"""
)
def union_all_splits(t: Tables) -> DataFrame:
    def split(name: str, key: str) -> DataFrame:
        table = getattr(t, name)
        return table.select(F.lit(name).alias("split"), F.col(key).alias("id"), "text")

    return dedupe.concat_splits(
        [split("documents", "doc_id"), split("conversations", "conv_id"), split("benchmark", "item_id")]
    )


@CATALOG.query(
    """
SELECT text, lang, doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS index
FROM (SELECT text, lang, max(doc_id) AS doc_id FROM documents GROUP BY text, lang)
"""
)
def dedupe_keep_last(t: Tables) -> DataFrame:
    """Copies of a text are kept at their last position; what is left is re-numbered."""
    rows = t.documents.select("text", "lang", "doc_id")
    return dedupe.reindex(dedupe.keep_last(rows, ["text", "lang"], "doc_id"), "doc_id")


@CATALOG.query("SELECT DISTINCT quality + toxic AS label_id FROM labels ORDER BY label_id")
def distinct_sorted(t: Tables) -> DataFrame:
    return (
        t.labels.select((F.col("quality") + F.col("toxic")).alias("label_id"))
        .distinct()
        .orderBy("label_id")
    )


@CATALOG.query("SELECT doc_id, text, lang FROM documents ORDER BY doc_id LIMIT 10")
def top_n(t: Tables) -> DataFrame:
    """The first rows by key: a look at the table, so the limit is the point."""
    return t.documents.select("doc_id", "text", "lang").orderBy("doc_id").limit(10)


@CATALOG.query(
    f"SELECT item, page, pos, orderid, time, comment, rating FROM ({views.NORMALIZED_SQL})"
)
def drop_repeats(t: Tables) -> DataFrame:
    """Pages landed twice give each record once, also those without an id."""
    pages = ingest.parse_pages(views.with_payload(t.events))
    keep = ("item", "page")
    once = ingest.normalize(ingest.explode_ratings(pages, keep), (*keep, "pos"))
    twice = once.unionByName(once)
    return ingest.drop_repeats(twice)
