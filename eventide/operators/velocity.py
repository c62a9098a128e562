"""Per-account velocity features: tumbling, hopping and sliding windows.

``velocity_tumbling`` is a partial+final hash aggregate on (keys, window);
``velocity_enrich`` joins that aggregate back to each event on (keys, window);
``velocity_sliding`` is a trailing RANGE frame.  For the sliding frame the
partition is (keys, day-bucket) rather than keys alone, with rows near a
bucket end copied into the next bucket as look-back "halo" rows, so a hot
account is split by time instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cols, r6

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(spec: str) -> float | None:
    """'5 minutes' -> 300.0; None when the form is not 'N unit'."""
    parts = spec.strip().lower().split()
    if len(parts) != 2:
        return None
    unit = parts[1].rstrip("s")
    try:
        return float(parts[0]) * _UNIT_SECONDS[unit]
    except (KeyError, ValueError):
        return None


def velocity_tumbling(df: DataFrame, keys: str | Sequence[str], ts: str, amount: str,
                      size: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Count, sum and mean of ``amount`` per key and (tumbling or hopping) window."""
    k = cols(keys)
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    out = (df.groupBy(*[F.col(c) for c in k], win.alias("_w"))
             .agg(F.count(F.lit(1)).alias("txn_count"),
                  F.sum(amount).alias("_sum")))
    return out.select(*k,
                      F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"),
                      F.col("txn_count"),
                      r6("_sum").alias("amount_sum"),
                      r6(F.when(F.col("txn_count") == 0, F.lit(0.0))
                         .otherwise(F.col("_sum") / F.col("txn_count"))).alias("amount_avg"))


def velocity_enrich(df: DataFrame, keys: str | Sequence[str], ts: str, amount: str,
                    size: str = "5 minutes", carry: Sequence[str] = ()) -> DataFrame:
    """Each event with the count/sum/mean of its own tumbling window.

    The window aggregate is a partial+final hash aggregate on (keys,
    window) and is joined back to the events on the same columns: the
    aggregate side is already partitioned by the join keys, the events are
    shuffled once, and a hot (key, window) is split by AQE's skew-join
    handling (a window function over that partition could not be split).
    """
    k = cols(keys)
    w = F.window(ts, size)
    base = df.select(*dict.fromkeys([*carry, *k, ts, amount]), w.start.alias("window_start"))
    agg = base.groupBy(*k, "window_start").agg(F.count(F.lit(1)).alias("win_count"), F.sum(amount).alias("_wsum"))
    return (base.join(agg, [*k, "window_start"])
                .select(*dict.fromkeys([*carry, *k, ts, amount]), "window_start", "win_count",
                        r6("_wsum").alias("win_amount_sum"),
                        r6(F.col("_wsum") / F.col("win_count")).alias("win_amount_avg")))


def velocity_sliding(df: DataFrame, keys: str | Sequence[str], ts: str, amount: str,
                     size: str = "5 minutes", bucket: str | None = None,
                     carry: Sequence[str] = ()) -> DataFrame:
    """Trailing ``size`` count/sum as of each event (RANGE frame on event time).

    ``bucket`` must be at least ``size``: each row is also copied, as a
    non-output halo row, into the next bucket when it lies within ``size``
    of its bucket's end, so every frame is complete inside one bucket.  By
    default a bucket is twelve windows long: a twelfth of the rows are copied, and
    a busy key's day is spread over as many tasks as it has buckets.
    """
    k = cols(keys)
    if bucket is None:
        bucket = f"{12 * _seconds(size)} seconds" if _seconds(size) is not None else "1 day"
    sz, bk = _seconds(size), _seconds(bucket)
    if sz is not None and bk is not None and sz > bk:
        raise ValueError(f"bucket ({bucket}) must be at least the window size ({size})")
    keep = list(dict.fromkeys([*carry, *k, ts, amount]))
    b = F.window(ts, bucket)
    base = df.select(*keep, b.start.alias("_b"), b.end.alias("_be"))
    halo = (base.filter(F.col(ts) + F.expr(f"INTERVAL {size}") > F.col("_be"))
                .withColumn("_b", F.col("_be")).withColumn("_halo", F.lit(True)))
    both = base.withColumn("_halo", F.lit(False)).unionByName(halo)
    part = ", ".join([f"`{c}`" for c in k] + ["_b"])
    frame = (f"PARTITION BY {part} ORDER BY `{ts}` "
             f"RANGE BETWEEN INTERVAL {size} PRECEDING AND CURRENT ROW")
    out = both.selectExpr("*", f"count(1) OVER ({frame}) AS trailing_count",
                          f"sum(`{amount}`) OVER ({frame}) AS _tsum")
    return out.filter(~F.col("_halo")).select(*keep, "trailing_count",
                                              r6("_tsum").alias("trailing_amount_sum"))
