"""Numbering and neighbours in a global order, in ranges of about equal size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Bits of a row's number inside its range, as ``monotonically_increasing_id`` lays them out.
_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str, scratch: Scratch) -> DataFrame:
    """``df`` with the column ``name``: 0, 1, 2, ... in the given order.

    Rows are dealt into ranges of the order, sorted there and written with their number
    inside the range; the sizes of the ranges, one for each task, shift them. No task holds
    more than its range, however many rows share a key, as long as the order's columns tell
    rows apart. ``df`` is read twice, so it should be a table or a cheap projection of one.
    """
    cut = scratch.put(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(name, F.monotonically_increasing_id())
    )
    part = F.shiftright(name, _ROW_BITS)
    sizes = cut.groupBy(part.alias("part")).count().collect()
    shifts, total = [], 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        shifts.append((row["part"], total - (row["part"] << _ROW_BITS)))
        total += row["count"]
    # one row for each range, so the table is as small as the list of tasks
    shift = df.sparkSession.createDataFrame(shifts, "_part long, _shift long")
    return (
        cut.join(F.broadcast(shift), part == F.col("_part"))
        .withColumn(name, F.col(name) + F.col("_shift"))
        .drop("_part", "_shift")
    )
