"""Query registry: name -> Spark callable, name -> DuckDB oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` query and, when the
    semantics are SQL-expressible, its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            from corpusflow.session import prepare
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from corpusflow.plans import (q_retrieval, q_chunking, q_masking, q_parsing,  # noqa: F401
                                  q_sources, q_governance)
