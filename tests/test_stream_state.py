"""Timers end the state of keys; peeks are no access."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators import ratelimit as RL
from eventide.operators.logs import kv_snapshot
from eventide.streaming import operators as SO
from eventide.streaming import runtime as RT

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def run(spark, df, build):
    """Rows of a stream over ``df`` (in slices by time), and the number of states after its last batch."""
    root, out = RT.scratch(spark, "state-in"), RT.scratch(spark, "state-out")
    files = RT.stage_by_time(df, "ts", root)
    s = build(SO.event_time(RT.file_stream(spark, root, df.schema, files), "ts", "1 second"))
    q = s.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    progress = [p for p in q.recentProgress if p["stateOperators"]]
    return spark.read.schema(s.schema).parquet(f"{out}/data"), progress[-1]["stateOperators"][0]["numRowsTotal"]


@pytest.mark.parametrize("ttl", [None, 20.0])
def test_buckets_that_are_full_again_hold_no_state(spark, ttl):
    r = random.Random(1)
    rows = [(i, f"c{r.randint(0, 30)}", at(r.randint(0, 300)), r.choice([0, 1, 1, 2, 3, 5])) for i in range(600)]
    rows.append((600, "last", at(5000), 1))
    df = spark.createDataFrame(rows, "i int, c string, ts timestamp, permits int")
    args = {"rate": 0.1, "capacity": 3.0, "idle_ttl": ttl, "tie": "i"}
    got, states = run(spark, df, lambda s: SO.token_bucket_stream(s, "c", "ts", "permits", **args, carry=["i"]))
    want = RL.token_bucket(df, "c", "ts", "permits", **args)
    cols = ["i", "allowed", "remaining", "reset_seconds"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert states == 1  # the last client's


def test_lapsed_and_deleted_keys_hold_no_state(spark):
    r = random.Random(2)
    rows = []
    for i in range(500):
        op = r.choice(["set", "set", "expire", "del"])
        rows.append((i, r.randint(0, 40), at(r.randint(0, 300)), op, f"v{i}" if op == "set" else None,
                     float(r.randint(1, 200)) if op == "expire" or (op == "set" and r.random() < .7) else None))
    # without expiry keys live on; these lapse or go as well
    rows += [(500 + k, k, at(400), "expire", None, 5.0) for k in range(41)]
    rows.append((999, 77, at(5000), "set", "kept", None))
    df = spark.createDataFrame(rows, "seq int, key bigint, ts timestamp, op string, value string, ttl double")
    got, states = run(spark, df, lambda s: SO.kv_stream(s, "key", "ts", "seq"))
    assert states == 1
    # the latest row of each key tells what is live at the end
    as_of = at(6000)
    last = got.groupBy("key").agg(F.max_by(F.struct("value", "expires_us", "present"), "as_of_us").alias("s"))
    live = last.filter(F.col("s.present") & (F.col("s.expires_us").isNull() | (F.col("s.expires_us") > F.unix_micros(F.lit(as_of)))))
    assert sorted(tuple(x) for x in live.select("key", "s.value").collect()) == \
        sorted((x.key, x.value) for x in kv_snapshot(df, as_of).collect()) == [(77, "kept")]
    gone = got.filter("NOT present").select("key").distinct().count()
    assert gone == 41


def test_a_peek_is_no_access(spark):
    rows = [(0, "c", at(0), 10), (1, "c", at(5), 0), (2, "c", at(8), 10), (3, "d", at(0), 0), (4, "d", at(1), 10), (5, "d", at(2), 1)]
    df = spark.createDataFrame(rows, "i int, c string, ts timestamp, permits int")
    args = {"rate": 0.5, "capacity": 10.0, "idle_ttl": 6, "tie": "i"}
    batch = {r.i: (r.allowed, r.remaining) for r in RL.token_bucket(df, "c", "ts", "permits", **args).collect()}
    got, _ = run(spark, df, lambda s: SO.token_bucket_stream(s, "c", "ts", "permits", **args, carry=["i"]))
    assert batch == {0: (True, 0.0), 1: (True, 2.5), 2: (True, 0.0), 3: (True, 10.0), 4: (True, 0.0), 5: (False, 0.5)}
    assert {r.i: (r.allowed, r.remaining) for r in got.collect()} == batch


@pytest.mark.parametrize("pieces,ttl", [("1", None), ("9", None), ("9", 25.0)])
def test_runs_between_refills_are_the_replay(spark, pieces, ttl):
    """One busy client over many pieces: equal to one replay of its whole log."""
    r = random.Random(6)
    t, rows = 0, []
    for i in range(3000):
        t += r.choice([0, 0, 1, 2, 5, 40 if r.random() < .2 else 3])
        rows.append((i, r.choice(["hot", "hot", "hot", "c", None]), at(t), r.choice([0, 1, 1, 2, 3])))
    df = spark.createDataFrame(rows, "i int, c string, ts timestamp, permits int")
    want, state = {}, {}
    for i, c, when, p in rows:
        us = int((when - T0).total_seconds() * 1_000_000)
        state[c], ok, left = RL.request(state.get(c), us, p, 0.1, 3.0, ttl)
        want[i] = (ok, round(left, 6))
    spark.conf.set("eventide.scan.pieces", pieces)
    try:
        got = RL.token_bucket(df, "c", "ts", "permits", 0.1, 3.0, idle_ttl=ttl, tie="i")
        assert got.columns == [*df.columns, "allowed", "remaining", "reset_seconds"]
        assert {x.i: (x.allowed, x.remaining) for x in got.collect()} == want
    finally:
        spark.conf.unset("eventide.scan.pieces")
