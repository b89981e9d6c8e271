"""Streaming operators that remember something from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Groups that the pages of one item are dealt to.
SALTS = 8
#: Groups, for each salt, that the items share; a fixed number, as it names groups of the state.
BUCKETS = 512
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_on_disk(spark: SparkSession) -> SparkSession:
    """Keep state in RocksDB below the checkpoint, so that it may outgrow the memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return spark


def drop_repeats(
    messages: DataFrame, time: str, keep_for: str, key: Sequence[str] = ("item", "page", "pos")
) -> DataFrame:
    """Records that a later poll delivers again are kept once, across micro-batches.

    A key is remembered until the watermark, ``keep_for`` behind the latest ``time``, has
    passed it, so the state holds the keys of that span and no more. A repeat carries the
    time of the record it repeats; one that comes after its key was forgotten is older than
    the watermark and is dropped as late. Which of the copies stays is not defined; they
    are the same record.
    """
    return messages.withWatermark(time, keep_for).dropDuplicatesWithinWatermark(list(key))


def prune_pages(
    pages: DataFrame, item: str, page: str, size: str, salts: int = SALTS
) -> DataFrame:
    """A stream of pages, in any order, to the pages that may belong to their items' lists.

    An item's list ends before its first empty page. The state is one number for each item
    and salt, the least empty page so far; pages behind it go, and each time it falls the
    empty page is handed on. What comes out is a table of pages again, so that
    ``ingest.assemble_pages`` over all of it gives the lists, at any moment and whatever the
    order of arrival: a page that got through before the stop was known is behind an empty
    page that is in the table too. An item with very many pages is dealt to ``salts`` groups,
    to all of which its empty pages go. Pages without an item pass.

    Items share ``BUCKETS`` groups for each salt, so a batch calls Python as often as that
    and not for each item; a group's state lists its items, as text, and their stops.
    """
    bucket, salt, name = "__bucket", "__salt", "__item"
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    own = F.array(F.pmod(F.xxhash64(page), F.lit(salts)).cast("int"))
    dealt = (
        pages.withColumn(salt, F.explode(F.when(F.col(size) == 0, every).otherwise(own)))
        .withColumn(bucket, F.pmod(F.xxhash64(item), F.lit(BUCKETS)).cast("int"))
        .withColumn(name, F.col(item).cast("string"))
    )
    columns = pages.columns

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stops = dict(zip(*state.get, strict=True)) if state.exists else {}
        first, fell = key[-1] == 0, False
        for chunk in chunks:
            # no item, no list to end
            listed = chunk[name].notna()
            empty = chunk[size] == 0
            least = chunk[empty & listed & chunk[page].notna()].sort_values(page)
            # of the rows that are alike one
            least = least.drop_duplicates(name)
            least = least[[x not in stops or y < stops[x] for x, y in zip(least[name], least[page], strict=True)]]
            if len(least):
                fell = True
                stops.update(zip(least[name], map(int, least[page]), strict=True))
            known = chunk[name].map(stops.__contains__).astype(bool)
            before = chunk[page] < chunk[name].map(lambda x: stops.get(x, 0))
            yield chunk[(~empty & (~known | before)) | (empty & ~listed & first)][columns]
            if first and len(least):
                yield least[columns]
        if fell:
            state.update((list(stops), list(stops.values())))

    return dealt.groupBy(bucket, salt).applyInPandasWithState(
        step, pages.schema, "items ARRAY<STRING>, stops ARRAY<LONG>", "append", GroupStateTimeout.NoTimeout
    )
