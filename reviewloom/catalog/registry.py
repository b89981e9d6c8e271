"""How queries are declared."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import configure


class Tables:
    """The given tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def files(self, name: str) -> str:
        """A pattern for the files of a table: a stream source wants no single file."""
        return f"{self.folder}/{name}*.parquet"


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


class Catalog(dict):
    def add(self, name: str, sql: str | None, body: Callable[[Tables], DataFrame]) -> None:
        if name in self:
            raise ValueError(f"query {name!r} is defined twice")
        self[name] = Entry(lambda spark, folder: body(Tables(spark, folder)), sql)

    def query(self, sql: str | None = None, name: str | None = None):
        """Register a function under its own name."""

        def register(body: Callable[[Tables], DataFrame]):
            self.add(name or body.__name__, sql, body)
            return body

        return register
