"""Keyed-table set operators: override merge, sorted merge, gaps, membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cols
from .scan import global_rank, running


def _tagged(dfs: Sequence[DataFrame | None]) -> DataFrame | None:
    out = None
    for i, d in enumerate(dfs):
        if d is None:  # a missing list is skipped
            continue
        t = d.withColumn("src_idx", F.lit(i))
        out = t if out is None else out.unionByName(t)
    return out


def merge_override(dfs: Sequence[DataFrame | None], key: str) -> DataFrame | None:
    """One row per key; the highest-index table that has the key wins.

    Union + one partial/final aggregate (max_by on the source index); no
    per-source joins.  Returns None when every input is None.
    """
    u = _tagged(dfs)
    if u is None:
        return None
    rest = [c for c in u.columns if c not in (key, "src_idx")]
    won = u.groupBy(key).agg(F.max_by(F.struct(*rest, "src_idx"), "src_idx").alias("_w"))
    return won.select(key, *[F.col(f"_w.{c}").alias(c) for c in rest], F.col("_w.src_idx").alias("src_idx"))


def sorted_merge(dfs: Sequence[DataFrame | None], key: str, pos: str) -> DataFrame | None:
    """All rows of the inputs in merged order (duplicates kept, the earlier
    input first on equal keys, then each input's own order).

    The result is range-partitioned and sorted by (key, src_idx, pos).
    """
    u = _tagged(dfs)
    if u is None:
        return None
    return u.orderBy(key, "src_idx", pos)


def merged_ranks(dfs: Sequence[DataFrame | None], key: str, pos: str, name: str = "merged_pos") -> DataFrame | None:
    """The rows of ``sorted_merge`` with their place in it (from 0), sorted once."""
    u = _tagged(dfs)
    return None if u is None else global_rank(u, [key, "src_idx", pos], name)


def missing_ids(df: DataFrame, id_col: str, lo: int | None = None, hi: int | None = None, keys=()) -> DataFrame:
    """Ids absent from [lo, hi] (defaults: the observed min and max), per key if ``keys`` are given.

    The gaps between neighbouring ids are filled, so the work follows the
    ids and the answer, not the span.  Without keys all ids form one group, which
    the running scan cuts into pieces.
    """
    k = cols(keys)
    group = k or ["_all"]
    seen = df if k else df.withColumn("_all", F.lit(0))
    seen = seen.select(*group, F.col(id_col).cast("bigint").alias("_id")).filter("_id is not null")
    if lo is not None:
        seen = seen.filter(F.col("_id") >= lo)
    if hi is not None:
        seen = seen.filter(F.col("_id") <= hi)
    some = seen.select(*group).distinct() if k else df.sparkSession.createDataFrame([(0,)], "_all int")
    for end in ([lo - 1] if lo is not None else []) + ([hi + 1] if hi is not None else []):
        seen = seen.unionByName(some.withColumn("_id", F.lit(end).cast("bigint")))
    gaps = running(seen.distinct(), group, "_id", {"_prev": ("last", "_id")}, exclusive=True) \
        .filter(F.col("_id") - F.col("_prev") > 1)
    return gaps.select(*k, F.explode(F.sequence(F.col("_prev") + 1, F.col("_id") - 1)).alias("missing_id"))


def missing_value(df: DataFrame, keys, v: str) -> DataFrame:
    """The one number of 0..n absent from a key's n values: n(n+1)/2 - sum, in integers."""
    return df.groupBy(*cols(keys)).agg(F.expr(f"count(1) * (count(1) + 1) div 2 - sum(cast(`{v}` as bigint))").alias("missing_value"))


def membership(df: DataFrame, words: DataFrame, on: str, word_col: str = "word",
               negate: bool = False) -> DataFrame:
    """Rows whose ``on`` value is (or with ``negate``, is not) in ``words``.

    A semi/anti join; Spark broadcasts the word list when its size is
    below the broadcast threshold and shuffles otherwise.
    """
    w = words.select(F.col(word_col).alias(on)).distinct()
    return df.join(w, on, "left_anti" if negate else "left_semi")
