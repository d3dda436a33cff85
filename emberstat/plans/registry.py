"""Query registry: key → (spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``; ``sql`` is
    the independent DuckDB formulation over the same parquet tables."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every query module so its keys are registered."""
    from . import q_prep, q_charts, q_text, q_topics, q_models  # noqa: F401
