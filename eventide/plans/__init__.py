"""Bindings of operators to the driver tables (``queries()``) with their
independent SQL oracles (``oracle_sql()``).

Each binding reads whole tables from ``sf_dir``; the SQL twin is written
directly against the same tables, not derived from the Spark code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a binding; ``sql`` is its DuckDB oracle (None = rows-only check)."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def _load_bindings() -> None:
    from . import features, graphs, logs, ml, sequences  # noqa: F401
    from . import serving  # noqa: F401
    from . import streams  # noqa: F401  (reuses the batch oracles)


_load_bindings()
