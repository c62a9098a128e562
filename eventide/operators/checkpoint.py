"""Epoch checkpoints with a manifest written last.

Layout under ``root`` (a shared folder, e.g. under spark.checkpoint.dir):
  epoch=N/   one-row parquet with the flattened state arrays
  manifest/  one-row parquet naming the last complete epoch
Resume reads the manifest first; a missing manifest or epoch folder means
start over.  Writes go through Spark, so any shared file system works.
"""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _encode(state: dict) -> dict:
    row = {"t": int(state["t"])}
    for part in ("params", "m", "v"):
        for k, arr in state[part].items():
            row[f"{part}__{k}"] = [float(x) for x in np.asarray(arr).ravel()]
            row[f"{part}__{k}__shape"] = list(np.asarray(arr).shape)
    return row


def _decode(row: dict) -> dict:
    out = {"t": int(row["t"]), "params": {}, "m": {}, "v": {}}
    for key, val in row.items():
        if key.endswith("__shape") or key in ("t", "epoch"):
            continue
        part, name = key.split("__", 1)
        shape = tuple(row[f"{key}__shape"])
        out[part][name] = np.asarray(val, dtype=np.float32).reshape(shape)
    return out


def save(spark: SparkSession, root: str, epoch: int, state: dict) -> None:
    row = _encode(state)
    row["epoch"] = int(epoch)
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").parquet(f"{root}/epoch={epoch}")
    (spark.createDataFrame([(int(epoch),)], "last_epoch int")
          .coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest"))


def load_latest(spark: SparkSession, root: str) -> dict | None:
    try:
        last = spark.read.parquet(f"{root}/manifest").agg(F.max("last_epoch")).first()[0]
        if last is None:
            return None
        row = spark.read.parquet(f"{root}/epoch={last}").first()
    except AnalysisException as e:
        # a missing or empty folder means a fresh start; anything else is an error
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if row is None:
        return None
    st = _decode(row.asDict())
    st["epoch"] = int(last)
    return st
