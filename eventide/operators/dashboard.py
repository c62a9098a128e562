"""Rolling dashboard metrics over the newest predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cols


def recent_n(df: DataFrame, order, n: int = 200) -> DataFrame:
    """Newest ``n`` rows, newest first (a distributed top-k: TakeOrderedAndProject)."""
    return df.orderBy(*[F.col(c).desc() for c in cols(order)]).limit(n)


def dashboard_metrics(preds: DataFrame, order, n: int = 200) -> DataFrame:
    """Over the newest ``n`` predictions: rows seen, flagged, mean of the
    non-null probabilities (0 when there is none)."""
    last = recent_n(preds, order, n)
    return last.agg(F.count(F.lit(1)).alias("rows_seen"),
                    F.count_if(F.coalesce(F.col("is_fraud"), F.lit(False))).alias("flagged"),
                    F.round(F.coalesce(F.avg("fraud_probability"), F.lit(0.0)), 6).alias("mean_probability"))
