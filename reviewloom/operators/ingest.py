"""Landed API pages to raw messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records as r
from .skew import salted_join


def parse_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``ratings``, the record list of each page; a page without one has an empty
    list. Each element is parsed on its own: one that is no record is null and leaves the
    others, and the length of the list, as they are."""
    listed = F.from_json(F.col(payload), r.API_PAGE)["data"]["ratings"]
    records = F.transform(listed, lambda x: F.when(_is_record(x), F.from_json(x, r.RATING)))
    return pages.withColumn(
        "ratings", F.coalesce(records, F.array().cast(f"ARRAY<{r.RATING}>"))
    )


def _is_record(element):
    return F.startswith(F.ltrim(element), F.lit("{"))


def page_rejects(pages: DataFrame, keep: Sequence[str] = (), payload: str = "payload") -> DataFrame:
    """The elements of pages that are no records: pos and value."""
    listed = F.from_json(F.col(payload), r.API_PAGE)["data"]["ratings"]
    elements = pages.select(*keep, F.posexplode_outer(listed).alias("pos", "value"))
    return elements.filter(F.col("pos").isNotNull() & ~F.coalesce(_is_record(F.col("value")), F.lit(False)))


def explode_ratings(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per rating record, in page order (``pos``).

    The outer form, since the inner one makes the optimizer test the list for being empty
    below the projection, which parses every page twice.
    """
    listed = pages.select(*keep, F.posexplode_outer("ratings").alias("pos", "rating"))
    return listed.filter(F.col("rating").isNotNull()).select(*keep, "pos", "rating.*")


def assemble_pages(
    pages: DataFrame, item: str, page: str, size: str, max_pages: int | None = None
) -> DataFrame:
    """The pages a client would have read: per item, those before its first empty page
    and, if given, before page ``max_pages``.

    The stop of each item is an aggregate with a partial step on the map side; pages go
    to it by a salted join, so an item with very many pages stays spread out.
    """
    stops = (
        pages.filter(F.col(size) == 0).groupBy(item).agg(F.min(page).alias("__stop"))
    )
    joined = salted_join(pages, stops, [item], "left")
    kept = joined.filter(F.col("__stop").isNull() | (F.col(page) < F.col("__stop")))
    if max_pages is not None:
        kept = kept.filter(F.col(page) < max_pages)
    return kept.drop("__stop")


def normalize(ratings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rating records to raw messages: all fields as text, ``N/A`` where missing."""
    return ratings.select(
        *keep,
        r.text_or_missing(F.col("rating_star")).alias("rating"),
        r.text_or_missing(F.col("comment")).alias("comment"),
        r.text_or_missing(F.col("orderid")).alias("orderid"),
        F.coalesce(r.epoch_text(F.col("ctime").try_cast("decimal(38,6)")), F.lit(r.MISSING)).alias("time"),
    )


# Why a message is set aside.
EMPTY, MALFORMED = "empty", "malformed"


def flag_rejects(messages: DataFrame, value: str = "value", schema=r.RAW_MESSAGE) -> DataFrame:
    """Add the parsed ``message`` and ``reason``: null for good rows, ``empty`` for null
    or empty values, ``malformed`` if no field could be read."""
    parsed = messages.withColumn("message", r.parse(F.col(value), schema))
    unread = F.lit(True)
    for field in schema.names:
        unread = unread & F.col(f"message.{field}").isNull()
    return parsed.withColumn(
        "reason",
        F.when(F.col(value).isNull() | (F.col(value) == ""), F.lit(EMPTY)).when(
            unread, F.lit(MALFORMED)
        ),
    )


def split_rejects(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good and rejected rows. Write ``flagged`` once if both are needed."""
    good = flagged.filter(F.col("reason").isNull()).drop("reason")
    return good, flagged.filter(F.col("reason").isNotNull()).drop("message")


def ingest_counts(flagged: DataFrame) -> DataFrame:
    """Received, sent and rejected messages and whether anything new came, in one row."""
    return flagged.agg(
        F.count("*").alias("received"),
        F.count_if(F.col("reason").isNull()).alias("sent"),
        F.count_if(F.col("reason") == EMPTY).alias("empty"),
        F.count_if(F.col("reason") == MALFORMED).alias("malformed"),
        F.coalesce(F.bool_or(F.col("reason").isNull()), F.lit(False)).alias("new_data"),
    )


def drop_repeats(messages: DataFrame, key: Sequence[str] = ("item", "page", "pos")) -> DataFrame:
    """Records that a restarted poll delivered again are kept once.

    A repeat is the same landed record, so the key is its place in the source. Records
    that only read alike, such as those without id and time, all stay.
    """
    return messages.dropDuplicates(list(key))
