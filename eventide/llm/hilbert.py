"""Sharding along a Hilbert curve.

Several metadata columns are quantised to a grid of 2**BITS cells each, the
cells are numbered along a Hilbert curve, and the rows in order of (curve
index, id) are cut into runs: shards with narrow ranges in all columns at
once, so that readers skip most files by their minima and maxima.

Quantising takes the bounds from the columns' own quantiles (at most 2**BITS - 1
of them; numbers are compared as doubles, so integers beyond 2**53 may share a cell
with their neighbours), for strings from the counts of their sorted values, so each
row's whole string decides its cell.  The sort is a range partitioning with the id as second key, so a
cell that holds a third of all rows is split; a row's rank is its place in its
partition plus the counts of the partitions before (one number each).

The law is ``rows``: shard = floor(rank * shards / rows), so counts are at most
one apart.

Defined cases: a null text has size 16 and checksum 0; a null in a metadata
column lies in cell 0; equal (index, id) are ordered by checksum and size;
fewer rows than shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scan import global_prefix_sum
from .staging import staged

BITS = 6
SHARDS = 40


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indices of points (n x dims, below 2**bits), by Skilling's transform (2004)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    if dims == 1:
        return x[0]
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations, from the largest cube down
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):  # bits of all dimensions in turn
        for i in range(dims):
            out = out << 1 | (x[i] >> b & 1)
    return out


def _string_bounds(df: DataFrame, name: str, parts: int) -> list[str]:
    """The least value of each part but the first, of ``parts`` parts of the rows that are as equal as whole values allow."""
    counts = df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    at = global_prefix_sum(counts, "v", "n", "before")
    total = at.agg(F.sum("n")).first()[0]
    if not total:
        return []
    part = F.expr(f"before * {parts} div {total}")
    return sorted(r["v"] for r in at.groupBy(part.alias("part")).agg(F.min("v").alias("v")).collect())[1:]


def cells(df: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """The grid cell of each column, by its quantiles; strings are compared whole."""
    words = [isinstance(df.schema[d].dataType, T.StringType) for d in dims]
    values = [F.col(d) if w else F.col(d).cast("double") for d, w in zip(dims, words)]
    steps = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    numbers = [i for i, w in enumerate(words) if not w]
    got = df.agg(*[F.percentile_approx(values[i], steps, 10000) for i in numbers]).first() if numbers else []
    cuts = dict(zip(numbers, got)) | {i: _string_bounds(df, dims[i], 1 << bits) for i, w in enumerate(words) if w}
    out = []
    for i, v in enumerate(values):
        bounds = sorted(set(cuts[i] or []))
        if not bounds:
            out.append(F.lit(0))
            continue
        below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: (b <= v) if words[i] else (b < v)))
        scaled = F.floor(below * F.lit(1 << bits) / F.lit(len(bounds) + 1))
        out.append(F.when(v.isNull(), F.lit(0)).otherwise(scaled).cast("int"))
    return out


def ranked(df: DataFrame, dims: list[str], ties: list[str], bits: int = BITS) -> tuple[DataFrame, int]:
    """``df`` (staged) with ``curve`` and ``rank`` (gapless from 0 along the curve), and its number of rows."""
    at = df.withColumns({f"cell_{i}": c for i, c in enumerate(cells(df, dims, bits))})
    names = [f"cell_{i}" for i in range(len(dims))]

    @F.pandas_udf("bigint")
    def index(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in parts:
            cols = cols if isinstance(cols, tuple) else (cols,)
            yield pd.Series(curve_index(np.stack([c.to_numpy() for c in cols], 1), bits))

    at = at.withColumn("curve", index(*names)).drop(*names)
    keys = ["curve", *ties]
    order = staged(at.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33).cast("int")
    counts = sorted(order.groupBy(part.alias("p")).count().collect())  # a number per range partition
    first, total = {}, 0
    for p, n in counts:
        first[p], total = total, total + n
    if not first:
        return order.withColumn("rank", F.col("place")).drop("place"), 0
    start = F.element_at(F.create_map(*[F.lit(x) for p, n in first.items() for x in (p, n)]), part)
    rank = (start + F.col("place").bitwiseAND((1 << 33) - 1)).cast("bigint")
    return order.withColumn("rank", rank).drop("place"), total


def shard(docs: DataFrame, dims: tuple[str, ...] = ("lang", "source", "size"), shards: int = SHARDS,
          id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """Per document: id, size, text_crc32, law, shard, slot (gapless from 0), grown_shard (null under this law)
    and its curve index.  ``size`` may be named as a dimension beside columns of ``docs``."""
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    own = [d for d in dims if d != "size"]
    base = docs.select(F.col(id_col).alias("id"), (F.length(raw) + 16).cast("bigint").alias("size"),
                       F.crc32(raw).alias("text_crc32"), *[F.col(d).alias(f"dim_{i}") for i, d in enumerate(own)])
    named = {d: f"dim_{i}" for i, d in enumerate(own)} | {"size": "size"}
    at, n = ranked(staged(base), [named[d] for d in dims], ["id", "text_crc32", "size"], bits)
    n = max(n, 1)
    run = F.expr(f"rank * {shards} div {n}")
    out = at.withColumn("shard", run.cast("int"))
    first = F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      (F.col("rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                      F.col("curve").alias("curve_index"))
