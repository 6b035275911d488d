"""Registry of named queries: a Spark builder and (when SQL can say it) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator adding ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLE_SQL)


def _load() -> None:
    # Importing the modules runs their @register decorators.
    from drawlake.plans import q_analysis, q_ingest, q_quality, q_tables, q_windows  # noqa: F401
