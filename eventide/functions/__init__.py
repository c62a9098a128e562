"""Small column helpers shared by operators (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output precision for floating results: both the Spark operators and
# the SQL oracles round to this many decimals so results compare exactly.
DP = 6


def r6(c: Column | str) -> Column:
    """Round a double to the fixed output precision."""
    return F.round(F.col(c) if isinstance(c, str) else c, DP)


def cols(names: str | Sequence[str] | None) -> list[str]:
    """Normalise a key/order argument to a list of column names."""
    if names is None:
        return []
    if isinstance(names, str):
        return [names]
    return list(names)


def ordered(names: Iterable[str], desc: bool = False) -> list[Column]:
    return [F.col(n).desc() if desc else F.col(n).asc() for n in names]


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def ceil_div(a: str, b: str) -> Column:
    """Exact integer ceiling division of two positive integer SQL expressions."""
    return F.expr(f"(({a}) + ({b}) - 1) div ({b})")
