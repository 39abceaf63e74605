"""Query registry: name -> Spark callable ``(spark, sf_dir) -> DataFrame`` and,
where the operator is SQL-expressible, an independent DuckDB oracle string."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a query (and its oracle) under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module so that its queries register."""
    from inkwell.plans import (  # noqa: F401
        catalog_audit,
        catalog_competitors,
        catalog_headings,
        catalog_events,
        catalog_keywords,
        catalog_responses,
        catalog_runs,
        catalog_scores,
    )
    from inkwell.plans import catalog_flagship  # noqa: F401  (composes the others)
    from inkwell.plans import catalog_streaming  # noqa: F401  (reuses batch oracles)
