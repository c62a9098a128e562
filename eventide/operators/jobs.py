"""Desired-versus-observed reconciliation of sharded training jobs.

desired: (job, worker_count); observed: (job, rank, succeeded, failed, active).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classify_status(obs: DataFrame) -> DataFrame:
    """Phase per observed worker, rules evaluated in the reference's order."""
    s, f, a = (F.coalesce(F.col(c), F.lit(0)) for c in ("succeeded", "failed", "active"))
    phase = (F.when(s > 0, "Succeeded").when(f >= 3, "Failed")
              .when(a == 0, "Pending").otherwise("Running"))
    return obs.withColumn("phase", phase).withColumn("restart_count", f.cast("bigint"))


def reconcile(desired: DataFrame, observed: DataFrame) -> DataFrame:
    """One row per desired (job, rank): missing -> create/Pending,
    Failed -> recreate/Resuming, else keep with its phase.  Observed
    ranks outside the desired range are ignored; no workers, no rows.  The
    last checkpointed epoch is taken over if ``observed`` has a column
    ``last_checkpoint_epoch``, else it is 0."""
    want = desired.filter(F.col("worker_count") > 0).select("job", F.explode(F.sequence(F.lit(0), F.col("worker_count") - 1)).alias("rank"))
    want = want.withColumn("rank", F.col("rank").cast("bigint"))
    epoch = F.col("last_checkpoint_epoch").cast("bigint") if "last_checkpoint_epoch" in observed.columns \
        else F.lit(0).cast("bigint")
    obs = classify_status(observed).select("job", F.col("rank").cast("bigint").alias("rank"),
                                           "phase", "restart_count", epoch.alias("_epoch"))
    j = want.join(obs, ["job", "rank"], "left")
    return j.select("job", "rank",
                    F.when(F.col("phase").isNull(), "create").when(F.col("phase") == "Failed", "recreate")
                     .otherwise("keep").alias("action"),
                    F.when(F.col("phase").isNull(), "Pending").when(F.col("phase") == "Failed", "Resuming")
                     .otherwise(F.col("phase")).alias("phase"),
                    F.coalesce("restart_count", F.lit(0).cast("bigint")).alias("restart_count"),
                    F.coalesce("_epoch", F.lit(0).cast("bigint")).alias("last_checkpoint_epoch"))


def status_rollup(statuses: DataFrame) -> DataFrame:
    """Overall phase and epoch per job (all Succeeded, any Failed, any
    Resuming, all Pending, else Running; epoch = min checkpoint epoch)."""
    ph = F.col("phase")
    g = statuses.groupBy("job").agg(
        F.bool_and(ph == "Succeeded").alias("_all_s"), F.bool_or(ph == "Failed").alias("_any_f"),
        F.bool_or(ph == "Resuming").alias("_any_r"), F.bool_and(ph == "Pending").alias("_all_p"),
        F.min("last_checkpoint_epoch").alias("current_epoch"), F.count(F.lit(1)).alias("workers"))
    return g.select("job",
                    F.when(F.col("_all_s"), "Succeeded").when(F.col("_any_f"), "Failed")
                     .when(F.col("_any_r"), "Resuming").when(F.col("_all_p"), "Pending")
                     .otherwise("Running").alias("phase"),
                    F.coalesce("current_epoch", F.lit(0).cast("bigint")).alias("current_epoch"), "workers")


def shard_rows(df: DataFrame, idx: str, n: int) -> DataFrame:
    """Rank shard = index mod world size, hash-partitioned into n partitions by shard."""
    return df.withColumn("shard", F.pmod(F.col(idx), F.lit(n)).cast("int")).repartition(n, "shard")
