"""Reference cases for log, set, slot and rate-limit operators, plus
randomized comparisons with direct replays."""

import random

from pyspark.sql import functions as F

from eventide.operators import logs as L
from eventide.operators import ratelimit as RL
from eventide.operators import sets as ST
from eventide.operators import slots as SL


def _kv(spark, pairs):
    return spark.createDataFrame(pairs, "key bigint, value bigint") if pairs else None


def test_merge_override(spark):
    lists = [_kv(spark, [(1, 70), (3, 20), (5, 30)]), _kv(spark, [(2, 40), (3, 50)]),
             _kv(spark, [(1, 15), (4, 80), (5, 90)])]
    got = sorted((r.key, r.value) for r in ST.merge_override(lists, "key").collect())
    assert got == [(1, 15), (2, 40), (3, 50), (4, 80), (5, 90)]
    assert ST.merge_override([None, None], "key") is None
    single = ST.merge_override([_kv(spark, [(10, 1), (20, 2), (30, 3)])], "key")
    assert sorted((r.key, r.value) for r in single.collect()) == [(10, 1), (20, 2), (30, 3)]
    coll = ST.merge_override([_kv(spark, [(7, 100)]), _kv(spark, [(7, 200)]), _kv(spark, [(7, 300)])], "key")
    assert [(r.key, r.value) for r in coll.collect()] == [(7, 300)]
    mixed = ST.merge_override([None, _kv(spark, [(2, 5), (4, 6)]), None, _kv(spark, [(1, 9), (4, 60)])], "key")
    assert sorted((r.key, r.value) for r in mixed.collect()) == [(1, 9), (2, 5), (4, 60)]


def test_sorted_merge(spark):
    a = spark.createDataFrame([(1, 0), (2, 1), (4, 2)], "key bigint, pos bigint")
    b = spark.createDataFrame([(1, 0), (3, 1), (4, 2)], "key bigint, pos bigint")
    assert [r.key for r in ST.sorted_merge([a, b], "key", "pos").collect()] == [1, 1, 2, 3, 4, 4]
    assert [r.src_idx for r in ST.sorted_merge([a, b], "key", "pos").collect()][:2] == [0, 1]
    e = spark.createDataFrame([], "key bigint, pos bigint")
    assert ST.sorted_merge([e, e], "key", "pos").count() == 0
    z = spark.createDataFrame([(0, 0)], "key bigint, pos bigint")
    assert [r.key for r in ST.sorted_merge([e, z], "key", "pos").collect()] == [0]


def test_missing(spark):
    df = spark.createDataFrame([("a", 3), ("a", 0), ("a", 1)], "k string, v bigint")
    assert ST.missing_value(df, "k", "v").collect()[0]["missing_value"] == 2


def test_missing_value_is_exact_for_large_counts(spark):
    n = 200_000_001  # one row stands for the sum of all others: n rows are not needed to see the division
    got = spark.sql(f"select {n}L * ({n}L + 1) div 2 as s").first().s
    assert got == n * (n + 1) // 2
    df = spark.range(1001).filter("id <> 77").select(F.lit("k").alias("k"), F.col("id").alias("v"))
    assert ST.missing_value(df, "k", "v").first().missing_value == 77


def test_missing_ids(spark):
    df = spark.createDataFrame([(5,), (1,), (2,), (9,), (9,), (None,)], "i bigint")
    ids = lambda d: sorted(r.missing_id for r in d.collect())
    assert ids(ST.missing_ids(df, "i")) == [3, 4, 6, 7, 8]
    assert ids(ST.missing_ids(df, "i", 0, 11)) == [0, 3, 4, 6, 7, 8, 10, 11]
    assert ids(ST.missing_ids(df.filter("i < 0"), "i", 1, 3)) == [1, 2, 3]
    assert ids(ST.missing_ids(df.filter("i < 0"), "i")) == []
    far = spark.createDataFrame([("a", 1), ("a", 3), ("b", 10**15), ("b", 10**15 + 2), ("c", 4)], "k string, i bigint")
    assert sorted(map(tuple, ST.missing_ids(far, "i", keys="k").collect())) == [("a", 2), ("b", 10**15 + 1)]
    ids = spark.createDataFrame([(1,), (2,), (5,), (7,)], "id bigint")
    assert sorted(r.missing_id for r in ST.missing_ids(ids, "id").collect()) == [3, 4, 6]


def test_hot_keys(spark):
    # touches 1, 2, 1, 3, (miss on 2: not a touch), 4 with capacity 2 -> {3, 4}
    log = spark.createDataFrame([(1, 0), (2, 1), (1, 2), (3, 3), (4, 5)], "key bigint, ts bigint")
    assert {r.key for r in L.hot_keys(log, "key", "ts", 2).collect()} == {3, 4}


def test_first_unique(spark):
    steps = [[1, 2, 3], [1], [2], [4, 5], [3], [4, 5], [6]]
    want = [1, 2, 3, 3, 4, None, 6]
    log, t = [], 0
    for s, w in zip(steps, want):
        for k in s:
            log.append((k, t))
            t += 1
        df = spark.createDataFrame(log, "key bigint, ts bigint")
        assert L.first_unique(df, "key", ["ts"]).collect()[0]["first_unique_key"] == w


def test_token_bucket(spark):
    df = spark.createDataFrame([("c", "2024-01-01 00:00:00", i, 1) for i in range(4)],
                               "client string, ts string, i int, permits int") \
        .withColumn("ts", F.to_timestamp("ts"))
    r = RL.token_bucket(df, "client", "ts", "permits", rate=1.0, capacity=3.0, tie="i").orderBy("i").collect()
    assert [x.allowed for x in r] == [True, True, True, False]


def _bucket_replay(events, rate, cap):
    out, st = [], {}
    for c, t, p in events:
        if c not in st:
            tok, last = cap, t
        else:
            tok, last = st[c]
            if t > last:
                tok, last = min(cap, tok + (t - last) * rate), t
        ok = tok >= p
        if ok:
            tok -= p
        st[c] = (tok, last)
        out.append(ok)
    return out


def test_token_bucket_random(spark):
    rnd = random.Random(7)
    ev = sorted(((rnd.choice("abc"), rnd.randint(0, 200), rnd.randint(0, 2)) for _ in range(400)), key=lambda x: x[1])
    ev = [(c, t, p, i) for i, (c, t, p) in enumerate(ev)]
    want = _bucket_replay([(c, t, p) for c, t, p, _ in ev], 0.05, 3.0)
    df = spark.createDataFrame(ev, "client string, t bigint, permits int, i int") \
        .withColumn("ts", F.timestamp_seconds("t"))
    got = {r.i: r.allowed for r in RL.token_bucket(df, "client", "ts", "permits", 0.05, 3.0, tie="i").collect()}
    assert [got[i] for i in range(len(ev))] == want


def test_kv_snapshot(spark):
    log = spark.createDataFrame([("k", "2024-01-01 00:00:00", 1, "set", "v", 0.05)],
                                "key string, ts string, seq int, op string, value string, ttl double") \
        .withColumn("ts", F.to_timestamp("ts"))
    assert L.kv_snapshot(log, "2024-01-01 00:00:00").count() == 1
    assert L.kv_snapshot(log, "2024-01-01 00:00:00.100").count() == 0


def _kv_replay(log, asof):
    store = {}
    for key, t, seq, op, val, ttl in sorted(log, key=lambda r: (r[1], r[2])):
        if t > asof:
            continue
        cur = store.get(key)
        if cur and cur[1] is not None and cur[1] <= t:
            store.pop(key)
            cur = None
        if op == "set":
            store[key] = (val, None if ttl is None else t + ttl)
        elif op == "del":
            store.pop(key, None)
        elif op == "expire" and cur:
            store[key] = (cur[0], t + ttl)
    return {k: v for k, v in store.items() if v[1] is None or v[1] > asof}


def test_kv_snapshot_random(spark):
    rnd = random.Random(3)
    log = []
    for i in range(600):
        op = rnd.choice(["set", "set", "del", "expire", "expire"])
        ttl = None if op == "del" or (op == "set" and rnd.random() < 0.3) else float(rnd.randint(1, 40))
        log.append((rnd.choice("abcdefgh"), rnd.randint(0, 300), i, op, f"v{i}", ttl))
    want = _kv_replay(log, 250)
    df = spark.createDataFrame(log, "key string, t bigint, seq int, op string, value string, ttl double") \
        .withColumn("ts", F.timestamp_seconds("t"))
    got = {r.key: r.value for r in L.kv_snapshot(df, "1970-01-01 00:04:10").collect()}
    assert got == {k: v[0] for k, v in want.items()}


def test_remove_n(spark):
    df = spark.createDataFrame([("l", 0, "c"), ("l", 1, "b"), ("l", 2, "a")], "k string, pos bigint, v string")
    step1 = L.remove_n(df, "k", "pos", "v", "b", 1)
    assert [r.v for r in step1.orderBy("pos").collect()] == ["c", "a"]
    step2 = L.remove_n(step1, "k", "pos", "v", "a", -1)
    assert [r.v for r in step2.orderBy("pos").collect()] == ["c"]


_LOG_SCHEMA = "entity string, seq bigint, op string, item string, key string, value string"


def test_fold_operations(spark):
    ops = [("e", 1, "update", None, "owner", "alice"), ("e", 2, "add", "A", None, None),
           ("e", 3, "remove", "B", None, None), ("e", 4, "update", None, "owner", "bob"),
           ("e", 5, "update", None, "owner", "carol"), ("e", 6, "add", "C", None, None),
           ("e", 7, "remove", "A", None, None)]
    log = spark.createDataFrame(ops, _LOG_SCHEMA)
    init = spark.createDataFrame([("e", "B")], "entity string, item string")
    rows = {(r.kind, r.name, r.value) for r in L.fold_operations(log, initial=init).collect()}
    assert rows == {("item", "C", None), ("meta", "owner", "carol")}


def _folded(ops):
    """Items and metadata left after applying ops in order."""
    items, meta = set(), {}
    for _, _, op, item, key, value in ops:
        if op == "add":
            items.add(item)
        elif op == "remove":
            items.discard(item)
        else:
            meta[key] = value
    return items, meta


def test_compact_and_batch_random(spark):
    """What the two rewrites promise: nothing lost but overwritten updates, the same final state, the
    other ops in their order, and every add as early as its item's last remove lets it."""
    rnd = random.Random(11)
    ops = []
    for e in "xy":
        for s in range(150):
            kind = rnd.choice(["add", "remove", "update", "update"])
            ops.append((e, s, kind, rnd.choice("pqr") if kind != "update" else None,
                        rnd.choice("kl") if kind == "update" else None, f"v{s}" if kind == "update" else None))
    log = spark.createDataFrame(ops, _LOG_SCHEMA)
    comp = L.compact_log(log)
    batched = L.batch_adds(comp).collect()
    for e in "xy":
        mine = [o for o in ops if o[0] == e]
        kept = {r.seq for r in comp.filter(F.col("entity") == e).collect()}
        for o, nxt in zip(mine, mine[1:] + [None]):  # only an update that the very next op overwrites goes
            assert (o[1] in kept) == (not (nxt and o[2] == nxt[2] == "update" and o[4] == nxt[4]))
        moved = [mine[r.seq] for r in sorted((r for r in batched if r.entity == e), key=lambda r: r.new_pos)]
        assert sorted(o[1] for o in moved) == sorted(kept)
        assert _folded(moved) == _folded(mine)
        rest = [o[1] for o in moved if o[2] != "add"]
        assert rest == sorted(rest)
        for i, o in enumerate(moved):
            if o[2] == "add":
                after = next((p for p in reversed(moved[:i]) if p[2] != "add"), None)
                last = max((p[1] for p in mine if p[2] == "remove" and p[3] == o[3] and p[1] < o[1]), default=None)
                assert (after and after[1]) == last


def test_allocate_and_free_slots(spark):
    req = spark.createDataFrame([(i, 1, "2024-02-01", i) for i in range(33)],
                                "event_id int, doctor_id int, day string, t int") \
        .withColumn("day", F.to_date("day")).withColumn("ts", F.timestamp_seconds("t"))
    docs = spark.range(1, 1001).select(F.col("id").cast("int").alias("doctor_id"))
    out = SL.allocate_slots(req, "doctor_id", "day", "ts", "event_id", docs, "2024-01-01").collect()
    by = {r.event_id: (r.status, r.slot) for r in out}
    assert [by[i] for i in range(32)] == [("ok", i) for i in range(32)]
    assert by[32] == ("conflict", None)
    assert SL.free_slots(spark.createDataFrame([r.asDict() for r in out if r.status == "ok"]),
                         "doctor_id", "day").count() == 0
    bad = spark.createDataFrame([(1, 0, "2024-02-01", 0), (2, 5, "2023-12-31", 0)],
                                "event_id int, doctor_id int, day string, t int") \
        .withColumn("day", F.to_date("day")).withColumn("ts", F.timestamp_seconds("t"))
    st = {r.event_id: r.status for r in SL.allocate_slots(bad, "doctor_id", "day", "ts", "event_id", docs,
                                                          "2024-01-01").collect()}
    assert st == {1: "not_found", 2: "bad_request"}


def test_slots_with_cancels(spark):
    rows = [(0, "book", None), (1, "book", None), (2, "cancel", 0), (3, "book", None), (4, "cancel", 5),
            (5, "cancel", 40)]
    log = spark.createDataFrame([(1, "2024-02-01", i, op, s) for i, op, s in rows],
                                "doctor_id int, day string, i int, op string, slot bigint")
    out = {r.i: (r.status, r.result_slot) for r in SL.slots_with_cancels(log, "doctor_id", "day", ["i"]).collect()}
    assert out == {0: ("ok", 0), 1: ("ok", 1), 2: ("ok", 0), 3: ("ok", 0), 4: ("not_found", None),
                   5: ("bad_request", None)}
