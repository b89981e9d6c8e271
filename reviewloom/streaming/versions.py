"""Lexicons that change while a stream runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_VERSION = "version"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def latest(spark: SparkSession, path: str) -> int:
    """The number of the last version, 0 if there is none."""
    stored = _read(spark, f"{path}/current")
    return 0 if stored is None else stored.agg(F.coalesce(F.max(_VERSION), F.lit(0))).first()[0]


def publish(lexicon: DataFrame, path: str) -> int:
    """Store a lexicon as the next version. Its rows are written first and its number after
    them, so a reader never meets half a version."""
    spark = lexicon.sparkSession
    version = latest(spark, path) + 1
    lexicon.write.mode("overwrite").parquet(f"{path}/rows/{version}")
    number = spark.range(1).select(F.lit(version).alias(_VERSION))
    number.coalesce(1).write.mode("append").parquet(f"{path}/current")
    return version


def read(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/rows/{version}")


def reloading(
    path: str,
    log: str,
    rewrite: Callable[[DataFrame, DataFrame], DataFrame],
    store: Callable[[DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """A handler that joins each batch with the version that is current when it begins.

    The version is noted under the number of the batch before the batch is stored, so that
    one run again after a failure takes the version it had, whatever was published since.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        noted = _read(spark, f"{log}/{batch_id}")
        row = None if noted is None else noted.first()
        version = row[0] if row is not None else latest(spark, path)
        if not version:
            raise ValueError(f"no version of the lexicon was published at {path}")
        if row is None:
            note = spark.range(1).select(F.lit(version).alias(_VERSION))
            note.coalesce(1).write.mode("overwrite").parquet(f"{log}/{batch_id}")
        store(rewrite(batch, read(spark, path, version)), batch_id)

    return handle
