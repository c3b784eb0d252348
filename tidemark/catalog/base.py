"""The query catalog: named DataFrame queries over the given tables, with checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.context import RunContext
from tidemark.session import tune, work_dir

# Run dates just after the last order and the last event of the given tables.
ORDERS_RUN = RunContext.of("2001-08-02", "2001-08-02 06:00:00")
EVENTS_RUN = RunContext.of("2024-01-31", "2024-01-31 06:00:00")


class Tables:
    """The given Parquet tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table that several readers need to the shared folder and read it back."""
        path = work_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(self.path(name))
        return self._read[name]


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None
    covers: str


CATALOG: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``build(tables)`` under a name with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Entry(build, sql, covers)
        return build

    return register
