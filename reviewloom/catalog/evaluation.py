"""Evaluation of the cleaned comments' score against the quality labels, and ingest counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.score import sentiment
from ..operators import evaluate, ingest
from ..plans.profiles import clean
from ..session import spread
from . import duck, views
from .registry import Catalog, Tables

CATALOG = Catalog()

CLASSES = (-1, 0, 1)
DIGITS = 6


def predictions(t: Tables) -> DataFrame:
    """The score of the cleaned review comment beside the label of its document. Labels
    are joined first, so that only labelled texts are cleaned."""
    comments = spread(views.reviews(t, views.COMMENT_WITH_MAIL))
    labelled = comments.join(t.labels.select("doc_id", "quality"), "doc_id")
    cleaned = clean(labelled, "comment")
    return cleaned.select(
        "doc_id",
        F.col("quality").alias("label_id"),
        sentiment(F.col("processed_comment")).alias("prediction"),
    )


_LABELLED_SQL = f"""
SELECT doc_id, quality AS label_id, comment FROM ({views.MAIL_REVIEWS_SQL}) JOIN labels USING (doc_id)
"""
_CLEANED_SQL = duck.chain(
    _LABELLED_SQL, "comment", duck.serving(), "processed_comment", "doc_id, label_id"
)
PREDICTIONS_SQL = f"""{_CLEANED_SQL}
SELECT doc_id, label_id, {duck.sentiment("processed_comment")} AS prediction FROM cleaned
"""

MEASURES_SQL = f"""
WITH p AS ({PREDICTIONS_SQL}),
c AS (SELECT label_id AS class FROM p UNION SELECT prediction FROM p),
n AS (
  SELECT class, (SELECT count(*) FROM p WHERE label_id = class) AS support,
         (SELECT count(*) FROM p WHERE prediction = class) AS predicted,
         (SELECT count(*) FROM p WHERE prediction = class AND label_id = class) AS hits
  FROM c
),
pr AS (
  SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM n
),
m AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                 ELSE 0 END AS f1 FROM pr
)
"""


def _summary(measure: str, name: str, sql: str) -> None:
    def body(t: Tables) -> DataFrame:
        pairs = evaluate.pair_counts(predictions(t), "label_id", "prediction")
        return evaluate.summary(evaluate.class_measures(pairs)).select(
            F.round(measure, DIGITS).alias(measure)
        )

    CATALOG.add(name, sql, body)


_summary(
    "accuracy",
    "eval_accuracy",
    f"SELECT round(avg((label_id = prediction)::INT::DOUBLE), {DIGITS}) AS accuracy FROM ({PREDICTIONS_SQL})",
)
for _m in ("precision", "recall", "f1"):
    _summary(
        f"weighted_{_m}",
        f"eval_weighted_{_m}",
        f"{MEASURES_SQL} SELECT round(sum({_m} * support) / sum(support), {DIGITS}) AS weighted_{_m} FROM m",
    )


@CATALOG.query(
    f"""{MEASURES_SQL}, r AS (
  SELECT class::VARCHAR AS class, precision, recall, f1, support FROM m
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(hits) / sum(support), sum(support) FROM m
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM m
)
SELECT class, round(precision, {DIGITS}) AS precision, round(recall, {DIGITS}) AS recall,
       round(f1, {DIGITS}) AS f1, support::BIGINT AS support FROM r"""
)
def eval_class_report(t: Tables) -> DataFrame:
    pairs = evaluate.pair_counts(predictions(t), "label_id", "prediction")
    report = evaluate.class_report(evaluate.class_measures(pairs))
    rounded = [F.round(m, DIGITS).alias(m) for m in ("precision", "recall", "f1")]
    return report.select("class", *rounded, "support")


@CATALOG.query(
    f"""
WITH p AS ({PREDICTIONS_SQL}), c AS (SELECT unnest([-1, 0, 1])::INT AS label)
SELECT label, count(*) FILTER (prediction = -1) AS predicted_minus_1,
       count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1
FROM c LEFT JOIN p ON label = label_id GROUP BY label
"""
)
def eval_confusion(t: Tables) -> DataFrame:
    pairs = evaluate.pair_counts(predictions(t), "label_id", "prediction")
    return evaluate.confusion(pairs, CLASSES)


COUNTS_SQL = """
SELECT count(*) AS received, count(*) FILTER (event_type IN ('click', 'purchase')) AS sent,
       count(*) FILTER (event_type IN ('signup', 'view')) AS empty,
       count(*) FILTER (event_type = 'error') AS malformed,
       count(*) FILTER (event_type IN ('click', 'purchase')) > 0 AS new_data
FROM events
"""


@CATALOG.query(COUNTS_SQL)
def ingest_counts(t: Tables) -> DataFrame:
    return ingest.ingest_counts(ingest.flag_rejects(views.mixed_messages(t)))
