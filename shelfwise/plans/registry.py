"""Registry of named queries: a Spark builder and, where SQL can say the same
thing, the equivalent ANSI SQL over the raw tables (the oracle)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    inventory: str  # SURVEY section 2 ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, inventory: str, sql: str | None = None):
    def wrap(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, inventory)
        return fn
    return wrap
