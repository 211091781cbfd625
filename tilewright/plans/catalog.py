"""All registered queries of the tile engine, by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """``run(spark, sf_dir)`` and, where SQL can express it, the DuckDB text with the same rows."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


_CATALOG: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable:
    """Decorator that adds a query to the catalog."""

    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        if name in _CATALOG:
            raise ValueError(f"query {name} is registered twice")
        _CATALOG[name] = Query(run, sql)
        return run

    return add


def _load() -> dict[str, Query]:
    from tilewright.plans import annotate, evaluation_queries, feature_queries, grid_queries, model_queries, slide_queries, tile_queries  # noqa: F401

    return _CATALOG


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query.run for name, query in _load().items()}


def oracle_sql() -> dict[str, str]:
    return {name: query.sql for name, query in _load().items() if query.sql}
