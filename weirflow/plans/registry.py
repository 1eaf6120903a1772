"""Registry of queries, each with the SQL text that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("words", "scalars", "relational", "social", "counts", "links", "logs", "sinks", "streams", "timers", "rollups", "intake", "models")


class Tables:
    """The tables of one folder, read when they are named."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Tables(spark, folder))


_REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the tables under its name."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in _REGISTRY:
            raise ValueError(f"the query {key} is defined twice")
        _REGISTRY[key] = Query(key, build, sql)
        return build

    return register


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"weirflow.plans.{module}")
    return dict(_REGISTRY)
