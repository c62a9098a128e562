"""Interval operators per key: union (merge), peak concurrency, min removals.

Intervals are closed pairs (start, end); touching intervals merge.  All
ordering uses running scans, so hot keys are split into pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cols
from ..session import drop_staged, staged
from .scan import running, split


def merge_intervals(df: DataFrame, keys, start: str, end: str) -> DataFrame:
    """Union of overlapping or touching intervals (gaps and islands)."""
    k = cols(keys)
    base = df.select(*k, start, end)
    # a total order: (start, end) ties are harmless for the max-end scan
    s = split(base, k, [start, end])
    m = running(s.df, k, [start, end], {"_pmax": ("max", end)}, exclusive=True, pieces=s)
    m = m.withColumn("_new", F.when(F.col("_pmax").isNull() | (F.col(start) > F.col("_pmax")), 1)
                              .otherwise(0))
    isl = running(m, k, [start, end], {"_island": ("sum", "_new")}, pieces=s)
    return (isl.groupBy(*k, "_island")
               .agg(F.min(start).alias(start), F.max(end).alias(end))
               .drop("_island"))


def max_concurrency(df: DataFrame, keys, start: str, end: str) -> DataFrame:
    """Peak number of simultaneously open intervals; an end frees before an equal start."""
    k = cols(keys)
    ev = (df.select(*k, F.col(start).alias("_t"), F.lit(1).alias("_d"))
            .unionByName(df.select(*k, F.col(end).alias("_t"), F.lit(-1).alias("_d"))))
    # (_t, _d) is not unique but equal rows are interchangeable for a running sum:
    # within a tie group the sum changes only after the whole group of equal deltas.
    ev = ev.groupBy(*k, "_t", "_d").agg(F.sum("_d").alias("_dd"))
    r = running(ev, k, ["_t", "_d"], {"_open": ("sum", "_dd")})
    return r.groupBy(*k).agg(F.max("_open").cast("long").alias("max_concurrency"))


def min_removals(df: DataFrame, keys, start: str, end: str) -> DataFrame:
    """Fewest intervals to drop so the rest do not overlap (touching is fine).

    The greedy choice by earliest end is a path in a forest: after an interval comes the one
    with the earliest end among those that start no earlier than it ends, which a running
    minimum from the right finds.  The length of the path from a key's first interval comes
    from pointer doubling: as many rounds as the logarithm of the longest path, and a
    key's intervals never meet in one task.  Equal intervals are one node; of those without
    length all are kept.  An interval that ends before it starts counts as one without length
    at its start; one with a null end is dropped by none and counted by none.
    """
    k = cols(keys)
    iv = df.select(*k, F.col(start).alias("_s"), F.greatest(F.col(start), F.col(end)).alias("_e")) \
           .filter(F.col(start).isNotNull() & F.col(end).isNotNull()) \
           .groupBy(*k, "_s", "_e").agg(F.count(F.lit(1)).alias("_n"))
    iv = staged(iv.withColumn("_id", F.monotonically_increasing_id()))
    empty = F.col("_s") == F.col("_e")
    me = F.struct("_e", "_s", "_id")
    # at one time, from the left: who asks, empty intervals, empty ones that ask (not for themselves), the others' starts
    ask = iv.select(*k, F.col("_e").alias("_t"), F.when(empty, 2).otherwise(0).alias("_kind"), "_id", F.lit(None).cast(iv.select(me).schema[0].dataType).alias("_me"))
    begin = iv.select(*k, F.col("_s").alias("_t"), F.when(empty, 1).otherwise(3).alias("_kind"), "_id", me.alias("_me"))
    seen = running(ask.unionByName(begin), k, ["_t", "_kind", "_id"], {"_next": ("min", "_me")}, reverse=True)
    hops = seen.filter(F.col("_me").isNull()).select("_id", F.col("_next._id").alias("_to"))
    weight = iv.select("_id", F.when(empty, F.col("_n")).otherwise(F.lit(1)).cast("bigint").alias("_w"))
    total = path_sums(hops.join(weight, "_id"), "_id", "_to", "_w")
    first = iv.groupBy(*k).agg(F.min(me).alias("_first"), F.sum("_n").alias("_all")).withColumn("_id", F.col("_first._id"))
    return first.join(total, "_id").select(*k, (F.col("_all") - F.col("_w")).cast("bigint").alias("min_removals"))


def path_sums(links: DataFrame, node: str, to: str, weight: str, max_rounds: int = 64) -> DataFrame:
    """(node, weight): the sum of the weights on the way from each node along ``to`` to its end, by pointer doubling."""
    cur = staged(links.select(F.col(node).alias("_v"), F.col(to).alias("_p"), F.col(weight).alias("_x")))
    for _ in range(max_rounds):
        if cur.filter("_p IS NOT NULL").isEmpty():
            return cur.select(F.col("_v").alias(node), F.col("_x").alias(weight))
        up = cur.select(F.col("_v").alias("_p"), F.col("_p").alias("_q"), F.col("_x").alias("_y"))
        nxt = staged(cur.join(up, "_p", "left").select("_v", F.col("_q").alias("_p"), (F.col("_x") + F.coalesce("_y", F.lit(0))).alias("_x")))
        drop_staged(cur)
        cur = nxt
    raise RuntimeError("paths longer than 2^max_rounds (or a cycle)")
