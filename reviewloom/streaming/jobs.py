"""Streaming queries: scoring, sinks, resume."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.lexicon import DEFAULT, Lexicons
from ..plans.scoring import score_messages, to_result_value
from ..sources.topics import kafka_write_options

# Trigger of the continuous jobs; None runs batches back to back.
DEFAULT_TRIGGER: str | None = None


def score_stream(
    messages: DataFrame, lexicons: Lexicons = DEFAULT, partitions: int | None = None
) -> DataFrame:
    """The scoring plan over a stream of raw messages, as result messages.

    ``partitions`` spreads the messages of a source with fewer partitions than the
    cluster has cores. A topic does that without a shuffle (``min_partitions``).
    """
    if partitions is not None:
        messages = messages.repartition(partitions)
    return to_result_value(score_messages(messages, lexicons=lexicons))


def _started(writer, checkpoint: str, every: str | None, drain: bool) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = DEFAULT_TRIGGER,
    drain: bool = False,
) -> StreamingQuery:
    """Append to a parquet folder. Its log of committed files makes delivery exactly
    once. With ``drain`` the query works off what is there and ends."""
    return _started(stream.writeStream.format("parquet").option("path", path), checkpoint, every, drain)


def to_topic(
    stream: DataFrame, checkpoint: str, every: str | None = DEFAULT_TRIGGER, **options
) -> StreamingQuery:
    """Append to a topic, at least once."""
    writer = stream.writeStream.format("kafka").options(**kafka_write_options(**options))
    return _started(writer, checkpoint, every, False)


def each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "5 seconds",
    drain: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch to ``handle(batch, batch_id)``."""
    return _started(stream.writeStream.foreachBatch(handle), checkpoint, every, drain)


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that stores each batch in a folder of its own. A batch that is run again
    after a failure replaces its folder, so nothing is stored twice."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def show_batches(rows: int = 10) -> Callable[[DataFrame, int], None]:
    """A handler that prints the first rows of each batch in full."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.show(rows, truncate=False)

    return handle


@contextmanager
def running(query: StreamingQuery) -> Iterator[StreamingQuery]:
    """Stop the query on the way out, whatever happened."""
    try:
        yield query
    finally:
        query.stop()


def drain(query: StreamingQuery) -> None:
    """Wait for a draining query; its failure is raised here."""
    with running(query):
        query.awaitTermination()
