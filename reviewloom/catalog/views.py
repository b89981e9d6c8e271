"""Review-shaped views of the given tables.

The given texts hold no Vietnamese, few links and no emoji, so reviews are the whole
text of a document with a phrase around it that gives every step something to do and
makes all scores occur. The expressions are plain SQL that both engines read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import records as r
from ..functions import steps as s
from .duck import mail, utc_text
from .registry import Tables

COMMENT = """
'Chất lượng sản phẩm: ' || text || ' Tính năng nổi bật: ' ||
CASE lang
  WHEN 'en' THEN 'rất tuyệt đẹp , hài lòng'
  WHEN 'fr' THEN 'xấu và kém quá, thất vọng'
  WHEN 'de' THEN 'đẹp nhưng dở'
  ELSE 'bình thường'
END ||
' 😀 :) hihiiii Okkkk tốtttt kk kkk x² a' || doc_id || '1 www.x.vn/' || doc_id ||
' http://y.vn/z #t' || doc_id || ' k k ko add sp | | mn t/g & không'
"""

# The same with addresses, which make the mail step drop whole stretches of text.
COMMENT_WITH_MAIL = f"""
{COMMENT} || CASE lang
  WHEN 'es' THEN ' hi @shop tốt. gửi a.b@c.com nhé'
  WHEN 'de' THEN ' x@y nhé @z'
  ELSE ''
END
"""

FIRST_SECOND = 1_704_067_200  # 2024-01-01


def reviews(t: Tables, comment: str = COMMENT) -> DataFrame:
    return t.documents.select("doc_id", F.expr(comment).alias("comment"))


REVIEWS_SQL = f"SELECT doc_id, {COMMENT} AS comment FROM documents"
MAIL_REVIEWS_SQL = f"SELECT doc_id, {COMMENT_WITH_MAIL} AS comment FROM documents"


def message_fields(t: Tables) -> DataFrame:
    """Raw messages as columns: one per document, and one without a comment per label."""
    from_documents = t.documents.select(
        F.format_string("d%d", F.col("doc_id")).alias("message_id"),
        (F.col("doc_id") % 5 + 1).cast("string").alias("rating"),
        F.expr(COMMENT).alias("comment"),
        F.col("doc_id").cast("string").alias("orderid"),
        r.epoch_text(F.col("doc_id") + FIRST_SECOND).alias("time"),
    )
    from_labels = t.labels.select(
        F.format_string("l%d", F.col("doc_id")).alias("message_id"),
        F.col("quality").cast("string").alias("rating"),
        F.lit(None).cast("string").alias("comment"),
        F.col("doc_id").cast("string").alias("orderid"),
        F.lit(r.MISSING).alias("time"),
    )
    return from_documents.unionByName(from_labels)


MESSAGE_FIELDS_SQL = f"""
SELECT 'd' || doc_id AS message_id, (doc_id % 5 + 1)::VARCHAR AS rating,
       {COMMENT} AS comment, doc_id::VARCHAR AS orderid,
       {utc_text(f"doc_id + {FIRST_SECOND}")} AS time
FROM documents
UNION ALL
SELECT 'l' || doc_id, quality::VARCHAR, NULL, doc_id::VARCHAR, 'N/A' FROM labels
"""


def messages(t: Tables) -> DataFrame:
    """Raw messages as bytes, the way a topic delivers them."""
    fields = message_fields(t)
    value = r.emit(*r.RAW_MESSAGE.names).cast("binary")
    return fields.select("message_id", value.alias("value"))


# One landed API page per event: none, one, two or three records, some incomplete.
PAGE_PAYLOAD = """
CASE event_type
  WHEN 'error' THEN '{"data":{"ratings":[]}}'
  WHEN 'signup' THEN '{"error":4}'
  ELSE '{"data":{"ratings":[{"rating_star":' || (event_id % 5 + 1) ||
       ',"comment":"' || event_type || ' ' || user_id || '","orderid":' || event_id ||
       ',"ctime":' || seconds || '}' ||
       CASE WHEN event_type IN ('click', 'purchase')
            THEN ',{"rating_star":2,"orderid":' || event_id || ',"ctime":0}' ELSE '' END ||
       CASE WHEN event_type = 'purchase' THEN ',{"comment":null,"ctime":null}' ELSE '' END ||
       ']}}'
END
"""


def with_payload(events: DataFrame) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return events.withColumn("seconds", seconds).select(
        F.col("user_id").alias("item"),
        F.col("event_id").alias("page"),
        F.expr(PAGE_PAYLOAD).alias("payload"),
    )


# The records those payloads hold, without going through JSON.
RATINGS_SQL = """
SELECT user_id AS item, event_id AS page, 0 AS pos,
       (event_id % 5 + 1)::INT AS rating_star, event_type || ' ' || user_id AS comment,
       event_id AS orderid, epoch_us(ts) // 1000000 AS ctime
FROM events WHERE event_type IN ('view', 'click', 'purchase')
UNION ALL
SELECT user_id, event_id, 1, 2, NULL, event_id, 0
FROM events WHERE event_type IN ('click', 'purchase')
UNION ALL
SELECT user_id, event_id, 2, NULL, NULL, NULL, NULL
FROM events WHERE event_type = 'purchase'
"""

NORMALIZED_SQL = f"""
SELECT item, page, pos, coalesce(rating_star::VARCHAR, 'N/A') AS rating,
       coalesce(comment, 'N/A') AS comment, coalesce(orderid::VARCHAR, 'N/A') AS orderid,
       CASE WHEN ctime > 0 THEN {utc_text("ctime")} ELSE 'N/A' END AS time
FROM ({RATINGS_SQL})
"""

# Messages of which some are broken or empty.
MIXED_VALUE = """
CASE event_type
  WHEN 'error' THEN '{"rating": '
  WHEN 'signup' THEN ''
  WHEN 'view' THEN CAST(NULL AS STRING)
  ELSE '{"rating":"' || (event_id % 5 + 1) || '","comment":"' || event_type ||
       '","orderid":"' || event_id || '"}'
END
"""


def mixed_messages(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.expr(MIXED_VALUE).alias("value"))


def mail_scrub(text: Column) -> Column:
    return s.mail(text)


MAIL_SCRUB_SQL = mail("text")
