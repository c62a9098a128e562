"""Per-key binary search run for all keys in lockstep.

``min_feasible_rate``: smallest integer rate k in [1, max(v)] with
sum(ceil(v / k)) <= budget (Koko).  The data is first reduced to a
(key, value, count) histogram and checkpointed; each round joins the
per-key bounds table to it and aggregates, so a round costs one pass over
the histogram, at most ~63 rounds for 64-bit values, and stops as soon as
every key has converged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ceil_div, cols
from ..session import cut_lineage


def min_feasible_rate(df: DataFrame, keys, v: str, budget, max_rounds: int = 64) -> DataFrame:
    """``budget`` is a number or the name of a per-key column."""
    k = cols(keys)
    bud = F.col(budget) if isinstance(budget, str) and budget in df.columns else F.lit(budget)
    hist = cut_lineage(df.groupBy(*k, F.col(v).cast("bigint").alias("_v"))
                         .agg(F.count(F.lit(1)).alias("_c"), F.first(bud).alias("_b")))
    bounds = (hist.groupBy(*k).agg(F.lit(1).cast("bigint").alias("lo"),
                                   F.max("_v").alias("hi"), F.first("_b").alias("_b")))
    bounds = bounds.withColumn("hi", F.greatest(F.col("hi"), F.lit(1)))
    for _round in range(max_rounds):
        bounds = cut_lineage(bounds)
        if bounds.filter(F.col("lo") < F.col("hi")).limit(1).count() == 0:
            break
        open_ = bounds.filter(F.col("lo") < F.col("hi")).withColumn("mid", F.expr("(lo + hi) div 2"))
        need = (hist.join(open_.select(*k, "mid"), k)
                    .groupBy(*k).agg(F.sum(ceil_div("_v", "mid") * F.col("_c")).alias("_need")))
        step = (open_.join(need, k, "left")
                     .withColumn("_ok", F.coalesce(F.col("_need"), F.lit(0)) <= F.col("_b"))
                     .select(*k, F.when(F.col("_ok"), F.col("lo")).otherwise(F.col("mid") + 1).alias("lo"),
                             F.when(F.col("_ok"), F.col("mid")).otherwise(F.col("hi")).alias("hi"), "_b"))
        done = bounds.filter(F.col("lo") >= F.col("hi"))
        bounds = done.unionByName(step)
    else:
        raise RuntimeError("min_feasible_rate did not converge")
    return bounds.select(*k, F.col("lo").alias("rate"))
