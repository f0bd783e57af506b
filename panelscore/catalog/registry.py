"""Registry of queries and of their SQL counterparts."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

_MODULES = ("panels", "feature_queries", "relation_queries", "score_queries", "quality_queries",
            "compare_queries", "job_queries")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return add


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"panelscore.catalog.{m}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
