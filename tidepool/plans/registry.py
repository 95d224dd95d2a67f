"""Registry of named queries: key -> (callable(spark, sf_dir), oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    key: str
    fn: QueryFn
    oracle: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(key: str, oracle: str | None = None, ops: tuple[str, ...] = ()):
    """Decorator: add a query to the registry (keys must be unique)."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, oracle, tuple(ops))
        return fn

    return deco
