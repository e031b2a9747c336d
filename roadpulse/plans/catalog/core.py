"""Registry of named queries over the test tables."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from roadpulse.plans.fixtures import Tables
from roadpulse.plans.oracle import with_views


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under ``name``; ``sql`` is its DuckDB equivalent."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, with_views(sql) if sql else None)
        return build

    return add
