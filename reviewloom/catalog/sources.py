"""Sources and batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records as r
from ..functions import steps as s
from ..operators import ingest
from ..plans.scoring import read_results
from ..session import new_folder
from ..sources import files
from . import duck, views
from .registry import Catalog, Tables

CATALOG = Catalog()


@CATALOG.query(views.RATINGS_SQL)
def src_page_payload(t: Tables) -> DataFrame:
    pages = ingest.parse_pages(views.with_payload(t.events))
    numbers = {"rating_star": "int", "orderid": "bigint", "ctime": "bigint"}
    rows = ingest.explode_ratings(pages, ("item", "page"))
    return rows.withColumns({c: F.col(c).try_cast(kind) for c, kind in numbers.items()})


PAGES_SQL = """
WITH pages AS (
  SELECT user_id AS item, event_id AS page,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 0 END AS size
  FROM events
),
stops AS (SELECT item, min(page) AS stop FROM pages WHERE size = 0 GROUP BY item)
SELECT item, page, size FROM pages LEFT JOIN stops USING (item) WHERE stop IS NULL OR page < stop
"""


@CATALOG.query(PAGES_SQL)
def page_assembly(t: Tables) -> DataFrame:
    pages = ingest.parse_pages(views.with_payload(t.events))
    sized = pages.select("item", "page", F.size("ratings").alias("size"))
    return ingest.assemble_pages(sized, "item", "page", "size")


@CATALOG.query("SELECT doc_id, text AS free_text, lang FROM documents")
def src_csv(t: Tables) -> DataFrame:
    """Texts with line breaks and quotes through a comma table and back."""
    table = t.documents.select("doc_id", F.col("text").alias("free_text"), "lang")
    path = new_folder(t.spark, "csv")
    files.write_csv(table, path)
    return files.read_csv(t.spark, path, table.schema)


_REVIEW_ROWS = f"""
SELECT rating AS "Rating", coalesce(comment, 'N/A') AS "Comment", orderid AS "Order ID", time AS "Time"
FROM ({views.MESSAGE_FIELDS_SQL})
"""


def _review_table(t: Tables) -> DataFrame:
    fields = views.message_fields(t).withColumn("comment", r.text_or_missing(F.col("comment")))
    path = new_folder(t.spark, "reviews")
    files.write_reviews(fields, path)
    return files.read_reviews(t.spark, path)


@CATALOG.query(_REVIEW_ROWS)
def sink_csv_semicolon(t: Tables) -> DataFrame:
    return _review_table(t)


@CATALOG.query(
    f'SELECT "Time", count(*) AS n, sum(length("Comment"))::BIGINT AS chars FROM ({_REVIEW_ROWS}) GROUP BY "Time"'
)
def src_csv_semicolon(t: Tables) -> DataFrame:
    return (
        _review_table(t)
        .groupBy("Time")
        .agg(F.count("*").alias("n"), F.sum(F.length("Comment")).alias("chars"))
    )


@CATALOG.query(f"SELECT DISTINCT unnest({duck.tokens('text')}) AS entry FROM conversations")
def src_lexicon_lines(t: Tables) -> DataFrame:
    """The words of all conversations as a line list with blank lines in it."""
    words = t.conversations.select(F.explode(s.token_array(F.col("text"))).alias("value"))
    path = new_folder(t.spark, "lines")
    words.unionByName(t.conversations.select(F.lit(" ").alias("value"))).write.text(path)
    return files.read_lines(t.spark, path)


@CATALOG.query(
    "SELECT p_partkey AS ord, p_name AS key, p_brand || '; \"' || p_type || '\"' AS value FROM part"
)
def src_dictionary(t: Tables) -> DataFrame:
    value = F.concat("p_brand", F.lit('; "'), "p_type", F.lit('"')).alias("value")
    rows = t.part.select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("key"), value)
    path = new_folder(t.spark, "dictionary")
    files.write_csv(rows, path)
    return files.read_dictionary(t.spark, path)


@CATALOG.query(
    "SELECT event_type AS processed_comment, (event_id % 3 - 1)::INT AS sentiment FROM events"
)
def result_decode(t: Tables) -> DataFrame:
    """Result messages read back by the fields the reader asks for; empty ones are skipped."""
    results = t.events.select(
        r.emit(
            F.lit("5").alias("rating"),
            F.col("event_type").alias("processed_comment"),
            (F.col("event_id") % 3 - 1).cast("int").alias("sentiment"),
        )
        .cast("binary")
        .alias("value")
    )
    empty = t.events.select(F.lit("").cast("binary").alias("value"))
    return read_results(results.unionByName(empty))
