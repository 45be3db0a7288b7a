"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL.

Each query reads the benchmark tables (whole tables, no subsets) and applies
one operator of the library. ``ORACLE`` holds the DuckDB SQL that computes
the same result independently; a query without an entry there is checked on
row counts only (and by unit tests against a brute-force fixture).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from strata.plans import (  # noqa: F401
        queries_behaviour,
        queries_commerce,
        queries_incremental,
        queries_medallion,
        queries_stored,
        queries_streaming,
        queries_tables,
        queries_violations,
    )


_load_all()
