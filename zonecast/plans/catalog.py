"""Registry of the queries exposed through ``__spark_entry__``.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` over the test tables
and, where the operator is expressible in SQL, the DuckDB oracle text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None
    ids: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ids: str = "") -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from zonecast.plans import batch, history, metrics, models, rolling, streams, tables  # noqa: F401

    return REGISTRY
