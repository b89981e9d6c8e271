"""Counters of a running stream, observed while its batches are written.

The counters are part of the streaming plan (``DataFrame.observe``), so they cost no pass
over the data. A listener stores those of each batch under the query and the number of the
batch: a batch that is run again after a failure replaces its counters, and one that the
sink has already and does not run again leaves them as they are. Totals add up what is
stored.

Counters are taken where ``observed`` stands in the plan; it should stand behind the last
shuffle, since rows of a shuffle that is made again would count twice.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.ingest import EMPTY, MALFORMED
from .jobs import drain

NAME = "ingest"
STORED = "received LONG, sent LONG, empty LONG, malformed LONG, query STRING, batch_id LONG"
_WAIT_SECONDS = 60


def observed(flagged: DataFrame, name: str = NAME) -> DataFrame:
    """Count received, sent and rejected messages as they pass."""
    return flagged.observe(
        name,
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("reason").isNull()).alias("sent"),
        F.count_if(F.col("reason") == EMPTY).alias("empty"),
        F.count_if(F.col("reason") == MALFORMED).alias("malformed"),
    )


class RunCounters(StreamingQueryListener):
    """Stores the counters of each batch below ``path``."""

    def __init__(self, spark: SparkSession, path: str, name: str = NAME):
        self.spark, self.path, self.name = spark, path, name
        self.ended: dict[str, threading.Event] = {}
        self.failure: Exception | None = None

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        try:
            progress = event.progress
            row = (progress.observedMetrics or {}).get(self.name)
            # a batch that the sink had already is not run, and counts nothing
            if row is not None and row["received"]:
                self.store(str(progress.id), progress.batchId, row.asDict())
        except Exception as e:  # noqa: BLE001 - raised to whoever waits for the query
            self.failure = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def store(self, query: str, batch_id: int, counts: dict[str, int]) -> None:
        values = [counts[x] for x in ("received", "sent", "empty", "malformed")]
        frame = self.spark.createDataFrame([(*values, query, batch_id)], STORED)
        frame.coalesce(1).write.mode("overwrite").json(f"{self.path}/{query}/{batch_id}")

    def drain(self, query: StreamingQuery) -> None:
        """Work a query off; all its counters are stored on return."""
        drain(query)
        # the end comes behind all progress, in the same line
        if not self._end(str(query.runId)).wait(_WAIT_SECONDS):
            raise TimeoutError(f"no end of run {query.runId} was reported")
        if self.failure is not None:
            raise self.failure

    def __enter__(self) -> RunCounters:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        self.spark.streams.removeListener(self)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The counters of each batch."""
    return spark.read.schema(STORED).json(f"{path}/*/*")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Received, sent and rejected messages of all batches, and whether anything new came."""
    rows = stored(spark, path)
    sums = [F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("received", "sent", "empty", "malformed")]
    return rows.agg(*sums).withColumn("new_data", F.col("sent") > 0)
