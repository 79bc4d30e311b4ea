"""Registry of named queries.

``register(name, oracle=...)`` records a callable ``(spark, sf_dir) -> DataFrame``
and, when the operator is SQL-expressible, an independent SQL text computing
the same rows over the generated tables (views named after the tables).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}
_COVERS: dict[str, tuple[str, ...]] = {}

PLAN_MODULES = (
    "sparkmart.plans.retail",
    "sparkmart.plans.ingestion",
    "sparkmart.plans.cleaning",
    "sparkmart.plans.reports",
    "sparkmart.plans.timeseries",
    "sparkmart.plans.basket",
    "sparkmart.plans.segments",
    "sparkmart.plans.pages",
    "sparkmart.plans.stores",
)


def register(name: str, oracle: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        _COVERS[name] = covers
        return fn
    return deco


def _load() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(m)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def coverage() -> dict[str, tuple[str, ...]]:
    _load()
    return dict(_COVERS)
