"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def salted_join(
    large: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join a large frame, whose keys may be badly skewed, with one that has few rows.

    Rows of one key are spread over ``salts`` partitions by a hash of ``spread_by`` (all
    columns by default); the keyed side is repeated once per salt. The hash depends on
    the row alone, so a recomputed task sends every row to the same place. If the keyed
    side turns out small enough, Spark broadcasts it and no row moves at all.
    """
    salt = "__salt"
    hashed = F.xxhash64(*(spread_by or large.columns))
    left = large.withColumn(salt, F.pmod(hashed, F.lit(salts)).cast("int"))
    right = keyed.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, salt], how).drop(salt)
