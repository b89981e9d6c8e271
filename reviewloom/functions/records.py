"""Schemas and conversions of review messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what a missing field reads.
MISSING = "N/A"

# All fields are text, so that none is lost for being of another type than expected.
RATING = "STRUCT<rating_star: STRING, comment: STRING, orderid: STRING, ctime: STRING>"
API_PAGE = "data STRUCT<ratings: ARRAY<STRING>>"

RAW_MESSAGE = T.StructType(
    [
        T.StructField("rating", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("orderid", T.StringType()),
        T.StructField("time", T.StringType()),
    ]
)
# What scoring needs of a raw message; a field that is not declared is not parsed.
SCORED_FIELDS = T.StructType([f for f in RAW_MESSAGE if f.name != "orderid"])

RESULT_MESSAGE = T.StructType(
    [
        T.StructField("rating", T.StringType()),
        T.StructField("original_comment", T.StringType()),
        T.StructField("processed_comment", T.StringType()),
        T.StructField("sentiment", T.IntegerType()),
        T.StructField("time", T.StringType()),
    ]
)
RESULT_READ = T.StructType(
    [f for f in RESULT_MESSAGE if f.name in ("processed_comment", "sentiment")]
)

TRAINING = T.StructType(
    [T.StructField("free_text", T.StringType()), T.StructField("label_id", T.IntegerType())]
)

REVIEW_CSV = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("Rating", "Comment", "Order ID", "Time")]
)

_LAST_SECOND = 253_402_300_799  # 9999-12-31 23:59:59


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in UTC, whatever the session zone is. Times up
    to 1970 and behind the year 9999 read ``N/A``, as missing ones do."""
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )
    return F.when(
        (seconds > 0) & (seconds <= _LAST_SECOND), moment.cast("string")
    ).otherwise(F.lit(MISSING))


def text_or_missing(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(MISSING))


def decode(value: Column) -> Column:
    """Message bytes to text."""
    return value.cast("string")


def parse(value: Column, schema: T.StructType | str = RAW_MESSAGE) -> Column:
    """JSON text to a struct. Broken JSON gives a struct of nulls, null gives null."""
    return F.from_json(value, schema)


def emit(*columns: str | Column) -> Column:
    """Columns to JSON text; null fields are left out."""
    return F.to_json(F.struct(*columns))


def binarize(label: Column) -> Column:
    """Three classes to clean (0) and harmful (1)."""
    return F.when(label == 2, F.lit(1)).otherwise(label).cast("int")
