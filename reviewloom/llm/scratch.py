"""Written intermediate tables of one operator run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import new_folder


class Scratch:
    """Tables below ``spark.checkpoint.dir`` that an operator writes and reads again.

    Executors that are lost take nothing with them. A table can be dropped as soon as
    nothing reads it any more; those that the returned frame reads stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name

    def put(self, df: DataFrame) -> DataFrame:
        path = new_folder(self.spark, self.name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        if _noted:
            _noted[-1].append(table)
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``put`` returned."""
        conf = self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(conf).delete(path, True)


#: Tables written inside calls of ``settled``, the innermost last.
_noted: list[list[DataFrame]] = []


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written; all tables that operators wrote for it are deleted."""
    scratch = Scratch(spark, name)
    _noted.append([])
    try:
        kept = scratch.put(make())
    finally:
        made = _noted.pop()
    scratch.drop(*[x for x in made if x is not kept])
    return kept


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches small: texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))
