"""Query registry: a name, a function of the tables, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablework.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ANSWERS: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(prepare(spark), folder))

        QUERIES[build.__name__] = run
        if sql:
            ANSWERS[build.__name__] = sql
        return build

    return register
