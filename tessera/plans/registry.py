"""Named queries and their SQL equivalents.

Each query is ``fn(spark, sf_dir) -> DataFrame``.  ``sql`` is the same
question written as DuckDB SQL over the raw tables (the correctness oracle);
``None`` marks a query whose output only gets a row-count check.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, operators: str = ""):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(operators.split()))
        return fn

    return wrap


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from tessera.plans import frames, orders, ratings, text_io  # noqa: F401

    return REGISTRY
