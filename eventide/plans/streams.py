"""Streaming bindings: each stages a time-ordered copy of its table in the
shared checkpoint folder, replays it through a file stream source with
``availableNow`` (several micro-batches), reads the sink back and is
compared with the batch oracle of the same operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ml as M
from ..operators.dashboard import dashboard_metrics
from ..sources import load
from ..sources.files import PREDICTION_SCHEMA, predictions_sink
from ..streaming import operators as SO
from ..streaming import runtime as RT
from . import ORACLES, register
from .logs import MIXED_BUCKET, PERMITS, _ASOF, kv_log
from .ml import EVENT_B, EVENT_W, _P_SQL


def events_stream(spark, sf_dir, name, cols=None):
    ev = load(spark, sf_dir, "events")
    if cols:
        ev = ev.select(*cols)
    root = RT.scratch(spark, name + "-in")
    fpt = RT.stage_by_time(ev, "ts", root)
    return RT.file_stream(spark, root, ev.schema, fpt)


def _velocity(spark, sf_dir, name, size, slide=None):
    s = SO.event_time(events_stream(spark, sf_dir, name, ["user_id", "ts", "value"]), "ts", "10 minutes")
    out = SO.velocity_windows(s, "user_id", "ts", "value", size, slide)
    return RT.run_update(out, name, ["user_id", "window_start"])


@register("stream_velocity_tumbling", None)
def stream_velocity_tumbling(spark, sf_dir):
    return _velocity(spark, sf_dir, "svt", "5 minutes")


@register("stream_velocity_hopping", None)
def stream_velocity_hopping(spark, sf_dir):
    return _velocity(spark, sf_dir, "svh", "1 hour", "15 minutes")


@register("stream_velocity_sliding", None)
def stream_velocity_sliding(spark, sf_dir):
    s = SO.event_time(events_stream(spark, sf_dir, "svs", ["event_id", "user_id", "ts", "value"]), "ts", "10 minutes")
    out = SO.sliding_velocity(s, "user_id", "ts", "value", 300, carry=["event_id"])
    r = RT.run_append(out, "svs")
    return r.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_token_bucket", None)
def stream_token_bucket(spark, sf_dir):
    s = SO.event_time(events_stream(spark, sf_dir, "stb", ["event_id", "user_id", "ts"]), "ts")
    s = s.withColumn("permits", F.lit(1))
    out = SO.token_bucket_stream(s, "user_id", "ts", "permits", 1 / 43200, 3.0, tie="event_id", carry=["event_id"])
    return RT.run_append(out, "stb").select("user_id", "event_id", "allowed", "remaining", "reset_seconds")


@register("stream_token_bucket_mixed", MIXED_BUCKET)
def stream_token_bucket_mixed(spark, sf_dir):
    s = SO.event_time(events_stream(spark, sf_dir, "stm", ["event_id", "user_id", "ts", "event_type"]), "ts")
    s = s.withColumn("permits", F.expr(PERMITS))
    out = SO.token_bucket_stream(s, "user_id", "ts", "permits", 1 / 43200, 3.0, idle_ttl=86400, tie="event_id", carry=["event_id"])
    return RT.run_append(out, "stm").select("user_id", "event_id", "allowed", "remaining", "reset_seconds")


@register("stream_first_unique", None)
def stream_first_unique(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    root = RT.scratch(spark, "sfu-in")
    fpt = RT.stage_by_time(li, "l_shipdate", root)
    s = RT.file_stream(spark, root, li.schema, fpt)
    # the key is the same in all rows of its group: plain values, so that the rows are hashed and not sorted
    agg = s.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first_seen"))
    once = RT.run_update(agg, "sfu", ["l_orderkey"]).filter(F.col("n") == 1)
    return once.agg(F.min_by("l_orderkey", F.struct("first_seen", "l_orderkey")).alias("first_unique_key"), F.min("first_seen").alias("first_seen"))


@register("stream_kv", None)
def stream_kv(spark, sf_dir):
    log = kv_log(spark, sf_dir).filter(F.col("ts") <= F.lit(_ASOF))
    root = RT.scratch(spark, "skv-in")
    fpt = RT.stage_by_time(log, "ts", root)
    s = SO.event_time(RT.file_stream(spark, root, log.schema, fpt), "ts")
    rows = RT.run_append(SO.kv_stream(s, "key", "ts", "seq"), "skv")
    last = rows.groupBy("key").agg(F.max_by(F.struct("value", "expires_us", "present"), "as_of_us").alias("s"))
    asof = F.unix_micros(F.lit(_ASOF).cast("timestamp"))
    live = last.filter(F.col("s.present") & (F.col("s.expires_us").isNull() | (F.col("s.expires_us") > asof)))
    return live.select("key", F.col("s.value").alias("value"),
                       F.when(F.col("s.expires_us").isNull(), F.lit(-1.0))
                        .otherwise(F.round((F.col("s.expires_us") - asof) / 1e6, 6)).alias("ttl_seconds"))


def _predictions(s):
    feats = s.withColumn("f", F.array(F.col("value") / F.lit(100.0), F.hour("ts") / F.lit(24.0)))
    sc = M.score_linear(feats, EVENT_W, EVENT_B, features="f", valid=F.col("event_type") != "error")
    return sc.select(F.col("event_id").cast("string").alias("transaction_id"),
                     F.col("user_id").cast("string").alias("account_id"), F.col("value").alias("amount"),
                     "ts", "event_id", "fraud_probability", "is_fraud")


@register("stream_score", f"""
WITH {_P_SQL},
v AS (SELECT event_id, count(*) OVER w AS velocity_count, round(sum(value) OVER w, 6) AS velocity_amount
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts
                               RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW))
SELECT transaction_id, account_id, amount, round_even(p, 6) AS fraud_probability, p > 0.5 AS is_fraud,
       velocity_count, velocity_amount
FROM pr JOIN v USING (event_id)
""")
def stream_score(spark, sf_dir):
    """Flagship stream: transactions in -> 5-minute velocity from keyed state
    -> score -> keyed JSON prediction records out (checkpointed sink)."""
    s = SO.event_time(events_stream(spark, sf_dir, "ssc"), "ts", "10 minutes")
    vel = SO.sliding_velocity(s, "user_id", "ts", "value", 300, carry=["event_id", "event_type"])
    preds = _predictions_with(vel)
    out = RT.scratch(spark, "ssc-out")
    q = predictions_sink(preds, f"{out}/data", f"{out}/_ckpt")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    txt = spark.read.text(f"{out}/data")
    return txt.select(F.from_json("value", PREDICTION_SCHEMA).alias("p")).select("p.*")


def _predictions_with(vel):
    """Score rows that already carry their trailing velocity."""
    feats = vel.withColumn("f", F.array(F.col("value") / F.lit(100.0), F.hour("ts") / F.lit(24.0)))
    sc = M.score_linear(feats, EVENT_W, EVENT_B, features="f", valid=F.col("event_type") != "error")
    return sc.select(F.col("event_id").cast("string").alias("transaction_id"),
                     F.col("user_id").cast("string").alias("account_id"), F.col("value").alias("amount"),
                     "fraud_probability", "is_fraud", F.col("trailing_count").alias("velocity_count"),
                     F.col("trailing_amount_sum").alias("velocity_amount"))


@register("stream_dashboard", None)
def stream_dashboard(spark, sf_dir):
    """After each micro-batch the rolling metrics over the newest 200 predictions; what is kept are those 200."""
    s = SO.event_time(events_stream(spark, sf_dir, "sdb"), "ts", None)
    preds = _predictions(s).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return RT.run_newest(preds, "sdb", ["ts", "event_id"], 200, lambda newest: dashboard_metrics(newest, ["ts", "event_id"], 200))


@register("stream_slots")
def stream_slots(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    log = ev.select("event_id", F.col("user_id").alias("doctor_id"), F.to_date("ts").alias("day"), "ts",
                    F.when(F.col("event_type") == "error", "cancel").otherwise("book").alias("op"),
                    F.when(F.col("event_type") == "error", k % 34).alias("slot"))
    root = RT.scratch(spark, "ssl-in")
    fpt = RT.stage_by_time(log, "ts", root)
    s = SO.event_time(RT.file_stream(spark, root, log.schema, fpt), "ts", None)
    out = SO.slots_stream(s, "doctor_id", "day", "ts", "event_id", carry=["event_id"])
    return RT.run_append(out, "ssl").select("event_id", "doctor_id", "day", "status", "result_slot")


def _share_oracles():
    """Streams must equal their batch operators: reuse the batch SQL oracle."""
    pairs = {"stream_velocity_tumbling": "velocity_tumbling", "stream_velocity_hopping": "velocity_hopping",
             "stream_velocity_sliding": "velocity_sliding", "stream_token_bucket": "token_bucket",
             "stream_first_unique": "first_unique", "stream_kv": "kv_snapshot",
             "stream_dashboard": "dashboard_metrics"}
    for s, b in pairs.items():
        ORACLES[s] = ORACLES[b]
    from .logs import SLOT_REPLAY

    ORACLES["stream_slots"] = (SLOT_REPLAY + """
SELECT event_id, l.doctor_id, l.day, status, result_slot
FROM l JOIN r ON l.doctor_id = r.doctor_id AND l.day = r.day AND l.rn = r.rn""").strip()


_share_oracles()
