"""Registry of named queries and their DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE_SQL[name]`` is the
same table computed by DuckDB over the parquet views.  Queries without an
SQL twin (model fits whose numbers come from an iterative solver, streaming)
are checked by invariants in ``tests/``.
"""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco
