"""Helpers on frames that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import drop_staged, staged

__all__ = ["drop_staged", "free_name", "staged"]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while a column of that name exists (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
