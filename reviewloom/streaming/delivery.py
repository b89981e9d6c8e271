"""Order inside a key, and restarts after a failed batch."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import reindex
from ..session import materialise

SEQUENCE = "seq"


def sequenced(
    messages: DataFrame, key: str, order: Sequence[str], before: DataFrame | None = None, output: str = SEQUENCE
) -> DataFrame:
    """Number the messages of each key 1, 2, 3, ... in the given order.

    ``before`` holds the last number of keys that have some already. Messages are numbered
    over all keys in ranges of equal size, and a key's numbers start at its first one, so a key
    with a large share of the messages is no single task. ``order`` must tell messages of a
    key apart.
    """
    place, first = "__place", "__first"
    sortable = F.struct(F.col(key).alias("k"), *[F.col(x).alias(f"o{i}") for i, x in enumerate(order)])
    numbered = materialise(
        reindex(messages.withColumn("__order", sortable), "__order", place).drop("__order"), "sequenced"
    )
    firsts = numbered.groupBy(key).agg(F.min(place).alias(first))
    if before is None:
        firsts = firsts.withColumn("__last", F.lit(0).cast("long"))
    else:
        known = before.select(F.col(key).alias("__key"), F.col(output).alias("__last"))
        firsts = (
            firsts.join(known, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
            .withColumn("__last", F.coalesce("__last", F.lit(0).cast("long")))
        )
    starts = firsts.select(F.col(key).alias("__key"), first, "__last")
    return (
        numbered.join(starts, F.col(key).eqNullSafe(F.col("__key")))
        .withColumn(output, F.col(place) - F.col(first) + 1 + F.col("__last"))
        .drop(place, first, "__last", "__key")
    )


def in_key_order(messages: DataFrame, key: str, output: str = SEQUENCE) -> DataFrame:
    """All messages of a key in one task and in order, as a topic's partition needs them."""
    return messages.repartition(key).sortWithinPartitions(key, output)


def append_in_order(path: str, key: str, order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A handler that numbers each batch behind the ones before and stores it in key order.

    A batch that is run again looks at the batches before it only, so it gets the numbers
    it had and replaces its folder.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = None
        if batch_id:
            try:
                stored = spark.read.parquet(path)
            except AnalysisException as e:
                # a failed first batch may have left nothing
                if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
            else:
                last = stored.filter(F.col("batch_id") < batch_id).groupBy(key).agg(F.max(SEQUENCE).alias(SEQUENCE))
        numbered = sequenced(batch, key, order, last)
        in_key_order(numbered, key).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def supervise(
    start: Callable[[], StreamingQuery],
    attempts: int = 5,
    pause: float = 1.0,
    longest_pause: float = 300.0,
    sleep: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """Run a query to its end and start it again from its checkpoint after a failure.

    The pause before a start doubles from ``pause`` up to ``longest_pause``. A run that got
    further than the one before, by the last batch it finished, begins the count anew; after
    ``attempts`` failures in a row at one place the last one is raised. Whether a message
    can come twice depends on the sink, as with any restart.
    """
    failures, reached = 0, -1
    while True:
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            progress = query.lastProgress
            at = progress["batchId"] if progress else -1
            failures = 1 if at > reached else failures + 1
            reached = max(at, reached)
            if failures >= attempts:
                raise
            sleep(min(longest_pause, pause * 2 ** (failures - 1)))
        finally:
            query.stop()
