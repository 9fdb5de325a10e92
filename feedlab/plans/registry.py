"""Named query registry used by ``__spark_entry__``.

A query is a callable ``(spark, sf_dir) -> DataFrame``.  When the result is
expressible in SQL it carries the equivalent DuckDB SQL over the same
Parquet tables (views ``events``, ``documents`` ...), used as the
correctness oracle.  Column names are aliased identically on both sides.
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


_REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_REGISTRY)


QUERY_MODULES = ("q_core", "q_io", "q_text", "q_features", "q_eval", "q_models", "q_embed", "q_drift", "q_rules")


def _load() -> None:
    # Importing the query modules fills the registry.
    import importlib
    for m in QUERY_MODULES:
        importlib.import_module(f"feedlab.plans.{m}")
