"""Registry of named queries over the test tables, each with its oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library operator(s)
on a stand-in input; ``ORACLE[name]`` is the same computation written in
plain SQL for DuckDB (views named after the test tables).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
DOCS: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a query under ``name`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        DOCS[name] = (fn.__doc__ or "").strip()
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import queries_branches, queries_core, queries_kmers, queries_pair, queries_sequences, queries_tables  # noqa: F401
