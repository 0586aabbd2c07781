"""Name -> (query, checking SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = query
    if oracle is not None:
        ORACLES[name] = oracle


def load() -> None:
    """Import every query module once."""
    import importlib

    for module in ("models_q", "ops_q", "pages_q", "reports_q", "match_q"):
        importlib.import_module(f"suite.{module}")
