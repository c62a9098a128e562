"""File and stream sources/sinks for transactions, predictions and params."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

N_FEATURES = 28

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("features", T.ArrayType(T.DoubleType())),
    T.StructField("_simulated_label", T.IntegerType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("fraud_probability", T.DoubleType()),
    T.StructField("is_fraud", T.BooleanType()),
    T.StructField("velocity_count", T.LongType()),
    T.StructField("velocity_amount", T.DoubleType()),
])

MODEL_PREDICTION_SCHEMA = T.StructType([*PREDICTION_SCHEMA.fields[:5], T.StructField("model_version", T.LongType())])

CSV_SCHEMA = T.StructType(
    [T.StructField(f"V{i}", T.DoubleType()) for i in range(1, N_FEATURES + 1)]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())])


def labeled_csv_source(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with V1..V28, Amount, Class -> (features array<double>[29], label).

    Explicit schema (no inference); a missing path raises FileNotFoundError.
    """
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        raise FileNotFoundError(f"{path} not found")
    df = spark.read.csv(path, header=True, schema=CSV_SCHEMA, mode="FAILFAST")
    cols = [F.col(f"V{i}") for i in range(1, N_FEATURES + 1)] + [F.col("Amount")]
    return df.select(F.array(*cols).alias("features"), F.col("Class").alias("label"))


def write_labeled_csv(df: DataFrame, path: str, features: str = "features", label: str = "label") -> None:
    """Inverse of ``labeled_csv_source`` (features[0..27] -> V1..V28, [28] -> Amount)."""
    out = df.select(*[F.get(F.col(features), i).alias(f"V{i + 1}") for i in range(N_FEATURES)],
                    F.get(F.col(features), N_FEATURES).alias("Amount"), F.col(label).cast("int").alias("Class"))
    out.write.mode("overwrite").option("header", True).csv(path)


def transactions_source(spark: SparkSession, fmt: str = "json", path: str | None = None,
                        options: dict | None = None, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """Streaming transactions.

    ``kafka``, ``keyed`` (Parquet files of key and value) and ``json`` (text
    files, a record a line): JSON records, parsed by ``json_records``; Kafka starts at
    the latest offsets unless told otherwise.  ``parquet``: a file source with
    the explicit schema.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")
        raw = spark.readStream.format("kafka").options(**opts).load()
        return json_records(raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")), schema)
    if fmt == "keyed":
        return json_records(spark.readStream.schema("key string, value string").options(**opts).parquet(path), schema)
    if fmt == "json":
        return json_records(spark.readStream.format("text").options(**opts).load(path), schema)
    return spark.readStream.format(fmt).schema(schema).options(**opts).load(path)


def json_records(raw: DataFrame, schema: T.StructType = TRANSACTION_SCHEMA,
                 required: tuple[str, ...] = ("transaction_id", "account_id", "timestamp", "amount")) -> DataFrame:
    """Rows with a JSON text ``value`` -> the other columns, the schema's fields, and ``corrupt``: the text of a
    record that isn't JSON of this schema or lacks a required field (its fields are then null), else null."""
    bad = T.StructField("_corrupt", T.StringType())
    parsed = F.from_json("value", T.StructType([*schema.fields, bad]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rest = [c for c in raw.columns if c != "value"]
    rows = raw.select(*rest, F.coalesce("value", F.lit("")).alias("value")).withColumn("t", parsed)
    fails = F.col("t").isNull() | F.col("t._corrupt").isNotNull()
    for c in required:
        fails = fails | F.col(f"t.{c}").isNull()
    rows = rows.withColumn("fails", fails)
    return rows.select(*rest, *[F.when(~F.col("fails"), F.col("t")[c]).alias(c) for c in schema.fieldNames()],
                       F.when(F.col("fails"), F.col("value")).alias("corrupt"))


def predictions_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "json",
                     trigger: dict | None = None, options: dict | None = None, schema: T.StructType = PREDICTION_SCHEMA):
    """Write predictions keyed by account as JSON records (Kafka: key/value
    columns; files: one JSON object per line).  Checkpointed: exactly-once
    file output, restartable."""
    rec = df.select(F.col("account_id").alias("key"),
                    F.to_json(F.struct(*[c for c in schema.fieldNames() if c in df.columns]))
                     .alias("value"))
    w = rec.writeStream.option("checkpointLocation", checkpoint).options(**(options or {}))
    if fmt == "kafka":
        w = w.format("kafka")
    else:
        w = rec.select("value").writeStream.option("checkpointLocation", checkpoint).options(**(options or {})) \
               .format("text").option("path", path)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def save_params(spark: SparkSession, path: str, mean, std) -> None:
    """Scaler parameters as a one-row JSON dataset (train and serve read the same file)."""
    spark.createDataFrame([(json.dumps({"Mean": list(map(float, mean)), "Std": list(map(float, std))}),)],
                          "params string").coalesce(1).write.mode("overwrite").text(path)


def load_params(spark: SparkSession, path: str) -> tuple[list[float], list[float]]:
    d = json.loads(spark.read.text(path).first()[0])
    return d["Mean"], d["Std"]


# --- versioned models -----------------------------------------------------------

MAX_MODEL_BYTES = 16 << 20  # of all versions that a job broadcasts
_LAYERS = ("W0", "b0", "W1", "b1", "W2", "b2")
_MODEL_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("valid_from", T.TimestampType()),
    T.StructField("mean", T.ArrayType(T.DoubleType())), T.StructField("std", T.ArrayType(T.DoubleType())),
    *(f for k in _LAYERS for f in (T.StructField(k, T.ArrayType(T.DoubleType())), T.StructField(f"{k}_shape", T.ArrayType(T.IntegerType()))))])


@dataclass
class Model:
    """A scaler and a network, in force from an event time on until the next version's."""

    version: int
    valid_from: dt.datetime
    mean: list[float]
    std: list[float]
    params: dict[str, np.ndarray]


def save_model(spark: SparkSession, root: str, model: Model) -> None:
    """Write one version below ``root``, as a folder of its own; saving a version again replaces it alone."""
    row = {"version": model.version, "valid_from": model.valid_from, "mean": [float(x) for x in model.mean], "std": [float(x) for x in model.std]}
    for k in _LAYERS:
        row[k] = [float(x) for x in model.params[k].ravel()]
        row[f"{k}_shape"] = list(model.params[k].shape)
    spark.createDataFrame([row], _MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/v={model.version}")


def load_models(spark: SparkSession, root: str) -> list[Model]:
    """All versions in the order of their times (equal times: by version, so that the later one holds)."""
    rows = spark.read.schema(_MODEL_SCHEMA).option("recursiveFileLookup", "true").parquet(root)
    size = 8 * (rows.agg(F.sum(sum((F.size(k) for k in _LAYERS), F.size("mean") + F.size("std")))).first()[0] or 0)
    if not size:
        raise ValueError(f"no model version below {root}")
    if size > MAX_MODEL_BYTES:
        raise ValueError(f"{size} bytes of model versions below {root}: retire old ones")
    return [Model(r["version"], r["valid_from"], r["mean"], r["std"],
                  {k: np.array(r[k], np.float32).reshape(r[f"{k}_shape"]) for k in _LAYERS})
            for r in rows.orderBy("valid_from", "version").collect()]
