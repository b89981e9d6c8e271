"""Record conversions, filters and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records as r
from ..operators import ingest, training
from ..session import materialise
from . import views
from .registry import Catalog, Tables

CATALOG = Catalog()


@CATALOG.query("SELECT event_id, props AS value FROM events")
def decode_value(t: Tables) -> DataFrame:
    raw = t.events.select("event_id", F.encode("props", "UTF-8").alias("value"))
    return raw.select("event_id", r.decode(F.col("value")).alias("value"))


@CATALOG.query("SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k FROM events")
def json_parse(t: Tables) -> DataFrame:
    parsed = t.events.select("event_id", r.parse(F.col("props"), "k BIGINT").alias("data"))
    return parsed.select("event_id", F.col("data.k").alias("k"))


@CATALOG.query("SELECT event_id, event_type AS kind, value AS amount, (props::JSON ->> 'k')::BIGINT AS k FROM events")
def json_expand(t: Tables) -> DataFrame:
    written = t.events.select(
        "event_id",
        r.emit(
            F.col("event_type").alias("kind"),
            F.col("value").alias("amount"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        ).alias("value"),
    )
    schema = "kind STRING, amount DOUBLE, k BIGINT"
    return written.select("event_id", r.parse(F.col("value"), schema).alias("data")).select(
        "event_id", "data.*"
    )


@CATALOG.query(
    f"SELECT message_id, rating, comment AS original_comment, time FROM ({views.MESSAGE_FIELDS_SQL})"
)
def project_nested(t: Tables) -> DataFrame:
    parsed = views.messages(t).select(
        "message_id", r.parse(r.decode(F.col("value"))).alias("value")
    )
    return parsed.select(
        "message_id",
        F.col("value.rating").alias("rating"),
        F.col("value.comment").alias("original_comment"),
        F.col("value.time").alias("time"),
    )


@CATALOG.query(
    """
SELECT event_id, '{"event_type":"' || event_type || '","user_id":' || user_id ||
       CASE WHEN event_type = 'error' THEN '' ELSE ',"label":"' || event_type || '"' END || '}' AS value
FROM events
"""
)
def json_emit(t: Tables) -> DataFrame:
    """Null fields are left out of the JSON."""
    label = F.when(F.col("event_type") != "error", F.col("event_type")).alias("label")
    return t.events.select(
        "event_id", r.emit("event_type", "user_id", label).alias("value")
    )


@CATALOG.query(
    f"SELECT message_id, coalesce(comment, '') AS comment FROM ({views.MESSAGE_FIELDS_SQL})"
)
def null_default(t: Tables) -> DataFrame:
    return views.message_fields(t).select(
        "message_id", F.coalesce("comment", F.lit("")).alias("comment")
    )


@CATALOG.query(views.NORMALIZED_SQL)
def normalize_message(t: Tables) -> DataFrame:
    pages = ingest.parse_pages(views.with_payload(t.events))
    return ingest.normalize(
        ingest.explode_ratings(pages, ("item", "page")), ("item", "page", "pos")
    )


@CATALOG.query(
    f"""
SELECT o_orderkey, CASE WHEN s > 0 THEN {views.utc_text("s")} ELSE 'N/A' END AS time
FROM (SELECT o_orderkey, (o_orderkey % 7 - 2) * 100000 * o_custkey AS s FROM orders)
"""
)
def epoch_format(t: Tables) -> DataFrame:
    """Seconds on both sides of zero and exactly zero."""
    seconds = (F.col("o_orderkey") % 7 - 2) * 100_000 * F.col("o_custkey")
    return t.orders.select("o_orderkey", r.epoch_text(seconds).alias("time"))


@CATALOG.query(
    """
(SELECT doc_id, label_id FROM (SELECT doc_id, quality + toxic AS label_id FROM labels)
 WHERE label_id = 0 ORDER BY doc_id LIMIT 10)
UNION ALL
(SELECT doc_id, label_id FROM (SELECT doc_id, quality + toxic AS label_id FROM labels)
 WHERE label_id = 1 ORDER BY doc_id LIMIT 5)
UNION ALL
(SELECT doc_id, label_id FROM (SELECT doc_id, quality + toxic AS label_id FROM labels)
 WHERE label_id = 2 ORDER BY doc_id LIMIT 5)
"""
)
def filter_label_head(t: Tables) -> DataFrame:
    """The first rows of each label: a report for the eye, so the limit is the point."""
    labelled = t.labels.select("doc_id", (F.col("quality") + F.col("toxic")).alias("label_id"))

    def head(label: int, n: int) -> DataFrame:
        return labelled.filter(F.col("label_id") == label).orderBy("doc_id").limit(n)

    return head(0, 10).unionByName(head(1, 5)).unionByName(head(2, 5))


@CATALOG.query(
    """
SELECT doc_id, quality + toxic AS label_id,
       CASE WHEN quality + toxic = 2 THEN 1 ELSE quality + toxic END AS binary_label
FROM labels
"""
)
def label_binarize(t: Tables) -> DataFrame:
    three = (F.col("quality") + F.col("toxic")).alias("label_id")
    return t.labels.select("doc_id", three, r.binarize(three).alias("binary_label"))


@CATALOG.query(
    """
SELECT doc_id, text AS free_text, CASE WHEN quality + toxic = 2 THEN 1 ELSE quality + toxic END AS label_id
FROM documents JOIN labels USING (doc_id)
"""
)
def training_frame(t: Tables) -> DataFrame:
    labelled = t.documents.select("doc_id", "text").join(t.labels, "doc_id")
    three = labelled.withColumn("three", F.col("quality") + F.col("toxic"))
    return training.training_frame(three, "text", "three", "doc_id")


@CATALOG.query(
    f"""
SELECT doc_id, out AS free_text, quality AS label_id FROM (
  SELECT doc_id, {views.MAIL_SCRUB_SQL} AS out FROM documents
) JOIN labels USING (doc_id) WHERE length(out) > 0
"""
)
def drop_empty(t: Tables) -> DataFrame:
    """Texts that the mail step leaves empty go, and their labels with them."""
    labels = t.labels.select("doc_id", F.col("quality").alias("label_id"))
    labelled = t.documents.select("doc_id", "text").join(labels, "doc_id").select(
        "doc_id", views.mail_scrub(F.col("text")).alias("free_text"), "label_id"
    )
    # written first: a filter on the scrubbed text would be pushed down and scrub twice
    return training.drop_empty(materialise(labelled, "scrubbed"))


@CATALOG.query(
    f"""
WITH m AS (SELECT event_id, event_type, {views.MIXED_VALUE} AS value FROM events)
SELECT event_id, CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'empty'
                                 WHEN 'view' THEN 'empty' END AS reason,
       CASE WHEN event_type IN ('click', 'purchase') THEN event_id::VARCHAR END AS orderid
FROM m
"""
)
def reject_split(t: Tables) -> DataFrame:
    """Good rows and rejects, told apart in one reading and parsing."""
    flagged = ingest.flag_rejects(views.mixed_messages(t))
    kept = F.when(F.col("reason").isNull(), F.col("message.orderid"))
    return flagged.select("event_id", "reason", kept.alias("orderid"))
