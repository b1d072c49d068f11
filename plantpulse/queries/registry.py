"""Registry of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plantpulse.session import prepare
from plantpulse.sources.standins import Plant, sql_views


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Plant], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Plant(prepare(spark), folder))


QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None) -> Callable:
    """Register ``build(plant)``; ``sql`` may name the stand-in views it reads."""

    def register(build: Callable[[Plant], DataFrame]) -> Callable:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(key, build, sql_views(sql) if sql else None)
        return build

    return register
