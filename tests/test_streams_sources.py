"""Streams equal their batch operators; sources, params and limiter edge cases."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from eventide.operators import graphs as G
from eventide.operators import ratelimit as RL
from eventide.sources import files as FS


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("stream,batch,cols", [
    ("stream_slots", "slots_with_cancels", ["event_id", "status", "result_slot"]),
    ("stream_token_bucket", "token_bucket", ["event_id", "allowed", "remaining"]),
    ("stream_velocity_sliding", "velocity_sliding", ["event_id", "trailing_count", "trailing_amount_sum"]),
    ("stream_kv", "kv_snapshot", ["key", "value", "ttl_seconds"]),
    ("stream_first_unique", "first_unique", ["first_unique_key", "first_seen"]),
])
def test_stream_equals_batch(spark, stream, batch, cols):
    q = E.queries()
    assert _rows(q[stream](spark, SF_SMALL), cols) == _rows(q[batch](spark, SF_SMALL), cols)


def test_params_roundtrip(spark, tmp_path):
    FS.save_params(spark, str(tmp_path / "p"), [1.0, 2.5], [0.5, 1.0])
    assert FS.load_params(spark, str(tmp_path / "p")) == ([1.0, 2.5], [0.5, 1.0])


def test_token_bucket_edges(spark):
    df = spark.createDataFrame([("c", 0, 0, 0), ("c", 1, 1, 5), ("c", 2, 3, 2), ("c", 3, 400, 1)],
                               "client string, i int, t long, permits int") \
        .withColumn("ts", F.timestamp_seconds("t"))
    r = {x.i: x for x in RL.token_bucket(df, "client", "ts", "permits", rate=0.01, capacity=3.0,
                                          idle_ttl=300, tie="i").collect()}
    assert r[0].allowed and r[0].remaining == 3.0          # permits = 0 is a peek
    assert not r[1].allowed and r[1].remaining == 3.0      # denied requests consume nothing
    assert r[2].allowed and r[2].remaining == 1.0          # refill is capped at 3, then 2 taken
    assert r[3].allowed and r[3].remaining == 2.0          # idle > 300 s: fresh full bucket
    for bad in ({"rate": 0, "capacity": 1}, {"rate": 1, "capacity": 0}, {"rate": 1, "capacity": 1, "idle_ttl": -1}):
        with pytest.raises(ValueError):
            RL.token_bucket(df, "client", "ts", "permits", **bad)
    neg = df.withColumn("permits", F.lit(-1))
    with pytest.raises(Exception):
        RL.token_bucket(neg, "client", "ts", "permits", 1.0, 1.0).collect()


def test_shortest_path_len(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11)], "src bigint, dst bigint")
    pairs = spark.createDataFrame([(0, 1, 4), (1, 1, 11)], "pair_id int, start bigint, end bigint")
    assert {r.pair_id: r.dist for r in G.shortest_path_len(e, pairs).collect()} == {0: 3, 1: None}
    d = G.shortest_path_len(e, pairs.limit(1), undirected=False).collect()[0]
    assert d.dist == 3
