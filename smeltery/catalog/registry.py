"""Named queries over the driver tables, each with the SQL that gives the same answer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from smeltery.session import configure


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


class Tables:
    """The tables of one folder, read on demand; timestamps come as UTC instants."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        instants = [c for c, kind in frame.dtypes if kind == "timestamp_ntz"]
        return frame.withColumns({c: frame[c].cast("timestamp") for c in instants})


def query(sql: str | None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(configure(spark), folder))

        QUERIES[build.__name__] = Query(build.__name__, run, sql)
        return build

    return register
