"""Named queries over the test tables, each with the SQL that gives the same answer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """`t("orders")` reads one table of a scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        REGISTRY[name or fn.__name__] = Query(lambda spark, folder: fn(Tables(spark, folder)), sql)
        return fn
    return register


def load() -> dict[str, Query]:
    from tidewell.workload import catalog, explore, ingest, profile, series, text  # noqa: F401

    return REGISTRY
