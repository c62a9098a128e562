"""The life of a model: trained, saved as a version, loaded by a stream of JSON records, and in force from an event time on.

Stand-in input: an event is a transaction whose features are the embedding with
its id modulo their number, amount = value; it arrives as a JSON record keyed by
its user.  The record of an error event breaks off, so it is no JSON.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import ml as M
from ..session import freed_shuffles, scratch_path, staged
from ..sources import load
from ..sources import files as FS
from ..streaming import runtime as RT
from . import register
from .ml import SPLIT_SQL, embedded, forward_sql, network_sql

# The versions of the stream queries: their networks have the initial weights of a seed.
VERSIONS = ((1, dt.datetime(2024, 1, 2), 42), (2, dt.datetime(2024, 1, 15), 7))


def transactions(spark, sf_dir):
    """(event_id, transaction_id, account_id, timestamp, amount, merchant_category, features)."""
    emb = load(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
    n = emb.count()
    ev = load(spark, sf_dir, "events").withColumn("vec_id", F.col("event_id") % F.lit(max(n, 1)))
    return ev.join(emb, "vec_id").select(
        "event_id", F.col("event_id").cast("string").alias("transaction_id"), F.col("user_id").cast("string").alias("account_id"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("amount"), F.col("event_type").alias("merchant_category"), "features")


def as_records(tx):
    """Keyed JSON records (ts, key, value) of transactions."""
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    whole = F.to_json(F.struct("transaction_id", "account_id", time.alias("timestamp"), "amount", "merchant_category", "features"))
    broken = F.concat(F.lit('{"transaction_id": "'), "transaction_id", F.lit('", "amount": '))
    return tx.select(F.col("timestamp").alias("ts"), F.col("account_id").alias("key"),
                     F.when(F.col("merchant_category") == "error", broken).otherwise(whole).alias("value"))


def record_stream(spark, sf_dir, name):
    """The transactions as a stream of keyed JSON records, in the order of their times."""
    root = RT.scratch(spark, name + "-in")
    tx = transactions(spark, sf_dir)
    tx = tx.repartition(max(2, -(-tx.count() // RT.FILE_ROWS)))  # few bytes of events become long records
    files = RT.stage_by_time(staged(as_records(tx)), "ts", root)
    return keyed_records(spark, root, files)


def keyed_records(spark, root, files):
    return FS.transactions_source(spark, "keyed", root, {"maxFilesPerTrigger": files, "recursiveFileLookup": "true"})


def replay_records(spark, sf_dir, name, start):
    """The stream of ``record_stream``, whose records are on disk for one slice of their times alone.

    ``start`` takes the stream and starts a query.  A slice has as many rows as there are embeddings at least, as each slice
    is joined with them.
    """
    root = RT.scratch(spark, name + "-in")
    rows = max(RT.SLICE_ROWS, load(spark, sf_dir, "embeddings").count())
    RT.replay(transactions(spark, sf_dir), "timestamp", root, lambda files: start(keyed_records(spark, root, files)), as_records, rows)


def published(spark, sf_dir):
    """The folder of the saved ``VERSIONS``; their scaler is fitted on the training split of the transactions."""
    tx = M.assemble_features(transactions(spark, sf_dir), "features", "amount", "x").select("event_id", F.col("x").alias("features"))
    train = M.split_train_test(tx, "event_id", 0.2, 42).filter(~F.col("is_test"))
    mean, std = M.scaler_params(M.fit_scaler(train))
    root = RT.scratch(spark, "models")
    for version, since, seed in VERSIONS:
        FS.save_model(spark, root, FS.Model(version, since, mean, std, M.init_mlp(seed)))
    return root


def scored(tx, models):
    """Predictions of transactions (28 features and an amount), table or stream."""
    s = M.score_versions(M.assemble_features(tx, "features", "amount"), models, "timestamp")
    return s.select("transaction_id", "account_id", "amount", "fraud_probability", "is_fraud", "model_version")


_SCORED_SQL = f"""
WITH {', '.join(network_sql(f'net{v}', M.init_mlp(seed)) for v, _, seed in VERSIONS)},
nets AS ({' UNION ALL '.join(f"SELECT {v} AS version, TIMESTAMP '{since}' AS since, * FROM net{v}" for v, since, _ in VERSIONS)}),
tx AS (SELECT event_id, user_id, ts, event_type, value, list_append(CAST(embedding[1:28] AS DOUBLE[]), value) AS f,
              {SPLIT_SQL.format(id='event_id')} AS is_test
       FROM events JOIN embeddings ON vec_id = event_id % (SELECT count(*) FROM embeddings)),
par AS (SELECT list(m ORDER BY i) AS m, list(CASE WHEN s < 1e-8 THEN 1 ELSE s END ORDER BY i) AS s
        FROM (SELECT i, avg(f[i]) AS m, stddev_pop(f[i]) AS s FROM tx, range(1, 30) u(i) WHERE NOT is_test GROUP BY i)),
rows AS (SELECT event_id, user_id, value, (SELECT max(version) FROM (VALUES {', '.join(f"({v}, TIMESTAMP '{since}')" for v, since, _ in VERSIONS)}) t(version, since) WHERE since <= ts) AS version,
                list_transform(range(1, 30), lambda i: (f[i] - par.m[i]) / par.s[i]) AS x
         FROM tx, par WHERE event_type <> 'error'),
s AS (SELECT event_id, user_id, value, rows.version, CASE WHEN rows.version IS NOT NULL THEN {forward_sql('x')} END AS p
      FROM rows LEFT JOIN nets ON nets.version = rows.version)
SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS account_id, value AS amount,
       round_even(p, 6) AS fraud_probability, p > 0.5 AS is_fraud, CAST(version AS BIGINT) AS model_version
FROM s
"""


@register("score_model", _SCORED_SQL)
def score_model(spark, sf_dir):
    """Batch scoring by the saved versions, as of each transaction's time."""
    models = FS.load_models(spark, published(spark, sf_dir))
    return scored(transactions(spark, sf_dir).filter("merchant_category <> 'error'"), models)


@register("stream_score_model", _SCORED_SQL)
def stream_score_model(spark, sf_dir):
    """JSON records in, broken ones set aside, 29 features scaled and scored by the version in force, JSON records out."""
    out = RT.scratch(spark, "ssm-out")
    with freed_shuffles(spark):
        models = FS.load_models(spark, published(spark, sf_dir))
        replay_records(spark, sf_dir, "ssm", lambda records: FS.predictions_sink(
            scored(records.filter("corrupt IS NULL"), models), f"{out}/data", f"{out}/_ckpt", options={"compression": "gzip"}, schema=FS.MODEL_PREDICTION_SCHEMA))
    got = F.from_json("value", FS.MODEL_PREDICTION_SCHEMA)
    return spark.read.text(f"{out}/data").select(got.alias("p")).select("p.*")


@register("stream_quarantine", """
SELECT CAST(user_id AS VARCHAR) AS key, '{"transaction_id": "' || event_id || '", "amount": ' AS corrupt
FROM events WHERE event_type = 'error' AND (SELECT count(*) FROM embeddings) > 0
""")
def stream_quarantine(spark, sf_dir):
    """The records of the stream that are no transactions, as they came."""
    return RT.run_append(record_stream(spark, sf_dir, "sqr").filter("corrupt IS NOT NULL").select("key", "corrupt"), "sqr")


def trained_version(spark, sf_dir, root, epochs=15):
    """Train on the training split (scaler too), save as version 1 below ``root``; returns the held-out rows."""
    rows = M.split_train_test(embedded(spark, sf_dir).select("vec_id", "features", "label"), "vec_id", 0.2, 42)
    train = rows.filter(~F.col("is_test"))
    FS.save_params(spark, f"{root}/scaler", *M.scaler_params(M.fit_scaler(train)))
    mean, std = FS.load_params(spark, f"{root}/scaler")
    params, history = M.train_mlp(staged(M.scale_features(train, mean, std)), epochs=epochs, lr=1e-2, batch_rows=256)
    FS.save_model(spark, f"{root}/models", FS.Model(1, dt.datetime(2024, 1, 1), mean, std, params))
    return rows.filter("is_test"), history


@register("train_save_serve")
def train_save_serve(spark, sf_dir):
    """A network trained and saved by one job and loaded by another: epochs, last training loss, rows and AUC of the held-out split."""
    root = scratch_path(spark, "models")
    test, history = trained_version(spark, sf_dir, root)
    served = M.score_versions(test.withColumn("ts", F.lit(dt.datetime(2024, 1, 2))), FS.load_models(spark, f"{root}/models"), "ts")
    auc = M.roc_auc(served, "fraud_probability", "label")
    return auc.select(F.lit(len(history)).alias("epochs"), F.lit(history[-1]["train_loss"]).alias("train_loss"), "auc", "n_pos", "n_neg")
