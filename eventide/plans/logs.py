"""Log, set, slot and fold bindings.

events -> op log: entity=user_id, seq=event_id, k=props.k;
click/signup = add item k, error = remove item k, view/purchase = update
key 'm'||(k%7) to the event id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import r6
from ..operators import folds as FO
from ..operators import logs as L
from ..operators import ratelimit as RL
from ..operators import sequences as S
from ..operators import sets as ST
from ..operators import slots as SL
from ..sources import load
from . import register

_K = "CAST(CAST(props->>'k' AS BIGINT) AS VARCHAR)"
_LOG_SQL = f"""l AS (
  SELECT user_id AS entity, event_id AS seq,
         CASE WHEN event_type IN ('click', 'signup') THEN 'add'
              WHEN event_type = 'error' THEN 'remove' ELSE 'update' END AS op,
         CASE WHEN event_type IN ('click', 'signup', 'error') THEN {_K} END AS item,
         CASE WHEN event_type IN ('view', 'purchase')
              THEN 'm' || CAST(CAST(props->>'k' AS BIGINT) % 7 AS VARCHAR) END AS key,
         CASE WHEN event_type IN ('view', 'purchase') THEN CAST(event_id AS VARCHAR) END AS value
  FROM events)"""


def op_log(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    et = F.col("event_type")
    is_item = et.isin("click", "signup", "error")
    is_upd = et.isin("view", "purchase")
    return ev.select(F.col("user_id").alias("entity"), F.col("event_id").alias("seq"),
                     F.when(et.isin("click", "signup"), "add").when(et == "error", "remove")
                      .otherwise("update").alias("op"),
                     F.when(is_item, k.cast("string")).alias("item"),
                     F.when(is_upd, F.concat(F.lit("m"), (k % 7).cast("string"))).alias("key"),
                     F.when(is_upd, F.col("event_id").cast("string")).alias("value"))


@register("fold_operations", f"""
WITH {_LOG_SQL},
li AS (SELECT entity, item, arg_max(op, seq) AS last FROM l WHERE op IN ('add', 'remove') GROUP BY entity, item),
lm AS (SELECT entity, key, arg_max(value, seq) AS v FROM l WHERE op = 'update' GROUP BY entity, key)
SELECT entity, 'item' AS kind, item AS name, CAST(NULL AS VARCHAR) AS value FROM li WHERE last = 'add'
UNION ALL
SELECT entity, 'meta', key, v FROM lm
""")
def fold_operations(spark, sf_dir):
    return L.fold_operations(op_log(spark, sf_dir))


_COMPACT_SQL = f"""{_LOG_SQL},
n AS (SELECT *, lead(CASE WHEN op = 'update' THEN key END) OVER (PARTITION BY entity ORDER BY seq) AS nk FROM l),
c AS (SELECT entity, seq, op, item, key, value FROM n
      WHERE NOT (op = 'update' AND nk IS NOT NULL AND nk = key))"""


@register("compact_log", f"WITH {_COMPACT_SQL} SELECT * FROM c")
def compact_log(spark, sf_dir):
    return L.compact_log(op_log(spark, sf_dir))


@register("batch_adds", f"""
WITH {_COMPACT_SQL},
a AS (SELECT *, max(CASE WHEN op = 'remove' THEN seq END)
                  OVER (PARTITION BY entity, item ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS arm
      FROM c)
SELECT entity, seq, op, item, key, value,
       row_number() OVER (PARTITION BY entity ORDER BY
           CASE WHEN op = 'add' THEN coalesce(arm, -1) ELSE seq END,
           CASE WHEN op = 'add' THEN 1 ELSE 0 END, -seq) - 1 AS new_pos
FROM a
""")
def batch_adds(spark, sf_dir):
    return L.batch_adds(L.compact_log(op_log(spark, sf_dir)))


for _name, _cnt in (("remove_n", 2), ("remove_n_tail", -3), ("remove_n_all", 0)):
    if _cnt == 0:
        _cond = "event_type = 'view'"
    else:
        _dir = "ASC" if _cnt > 0 else "DESC"
        _cond = f"event_type = 'view' AND rk <= {abs(_cnt)}"
    _sql = f"""
SELECT user_id, event_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type = 'view' ORDER BY ts {"ASC" if _cnt >= 0 else "DESC"}) AS rk
  FROM events) t
WHERE NOT ({_cond})
"""

    def _q(spark, sf_dir, _cnt=_cnt):
        ev = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
        return L.remove_n(ev, "user_id", "ts", "event_type", "view", _cnt)
    register(_name, _sql)(_q)


@register("hot_keys", """
SELECT CAST(props->>'k' AS BIGINT) AS k, max(ts) AS last_access
FROM events GROUP BY 1 ORDER BY last_access DESC, k LIMIT 10
""")
def hot_keys(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(F.get_json_object("props", "$.k").cast("bigint").alias("k"), "ts")
    return L.hot_keys(ev, "k", "ts", 10)


@register("first_unique", """
WITH p AS (SELECT l_orderkey, min(l_shipdate) AS fs FROM lineitem GROUP BY l_orderkey HAVING count(*) = 1)
SELECT (SELECT l_orderkey FROM p ORDER BY fs, l_orderkey LIMIT 1) AS first_unique_key,
       (SELECT min(fs) FROM p) AS first_seen
""")
def first_unique(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    return L.first_unique(li, "l_orderkey", ["l_shipdate", "l_orderkey"])


_ASOF = "2024-01-15 12:00:00"


def kv_log(spark, sf_dir):
    """Events as operations on a key; a view is a read, which changes no key and is left out of the log."""
    ev = load(spark, sf_dir, "events")
    et = F.col("event_type")
    return (ev.filter(et != "view")
              .select(F.get_json_object("props", "$.k").cast("bigint").alias("key"), "ts",
                      F.col("event_id").alias("seq"),
                      F.when(et.isin("signup", "purchase"), "set").when(et == "click", "expire")
                       .otherwise("del").alias("op"),
                      F.when(et.isin("signup", "purchase"), F.col("event_id").cast("string")).alias("value"),
                      F.when(et == "purchase", F.col("value") * 3600)
                       .when(et == "click", F.col("value") * 600).alias("ttl")))


@register("kv_snapshot", f"""
WITH g AS (
  SELECT CAST(props->>'k' AS BIGINT) AS key, ts, event_id AS seq, epoch_us(ts) AS t,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'set'
              WHEN event_type = 'click' THEN 'expire' ELSE 'del' END AS op,
         CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(event_id AS VARCHAR) END AS value,
         CASE WHEN event_type = 'purchase' THEN value * 3600 WHEN event_type = 'click' THEN value * 600 END AS ttl
  FROM events WHERE event_type <> 'view' AND ts <= TIMESTAMP '{_ASOF}'),
x AS (SELECT *, t + CAST(round(ttl * 1e6) AS BIGINT) AS exp FROM g),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t DESC, seq DESC) AS rr
                     FROM x WHERE op IN ('set', 'del')) q WHERE rr = 1),
live AS (SELECT key, value, t AS st, seq AS sseq, exp AS sexp FROM s WHERE op = 'set'),
ch AS (SELECT live.key, live.st AS t, live.sseq AS seq, live.sexp AS exp, 1 AS is_seed FROM live
       UNION ALL
       SELECT x.key, x.t, x.seq, x.exp, 0 FROM x JOIN live ON x.key = live.key
       WHERE x.op = 'expire' AND (x.t > live.st OR (x.t = live.st AND x.seq > live.sseq))),
lg AS (SELECT *, lag(exp) OVER (PARTITION BY key ORDER BY t, seq) AS pexp,
              row_number() OVER (PARTITION BY key ORDER BY t DESC, seq DESC) AS rdesc FROM ch),
f AS (SELECT key, max(CASE WHEN is_seed = 0 AND pexp IS NOT NULL AND pexp <= t THEN 1 ELSE 0 END) AS lapsed,
             max(CASE WHEN rdesc = 1 THEN exp END) AS fexp FROM lg GROUP BY key)
SELECT live.key, live.value,
       CASE WHEN fexp IS NULL THEN -1.0 ELSE round((fexp - epoch_us(TIMESTAMP '{_ASOF}')) / 1e6, 6) END AS ttl_seconds
FROM live JOIN f USING (key)
WHERE lapsed = 0 AND (fexp IS NULL OR fexp > epoch_us(TIMESTAMP '{_ASOF}'))
""")
def kv_snapshot(spark, sf_dir):
    return L.kv_snapshot(kv_log(spark, sf_dir), _ASOF)


# --- sets ----------------------------------------------------------------------

def _versions(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return [o,
            o.filter(F.col("o_orderkey") % 2 == 0).withColumn("o_totalprice", F.col("o_totalprice") * 1.1),
            o.filter(F.col("o_orderkey") % 3 == 0).withColumn("o_totalprice", F.col("o_totalprice") * 0.9)]


@register("merge_override", """
SELECT o_orderkey,
       round(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 0.9
                  WHEN o_orderkey % 2 = 0 THEN o_totalprice * 1.1 ELSE o_totalprice END, 6) AS o_totalprice,
       CASE WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS src_idx
FROM orders
""")
def merge_override(spark, sf_dir):
    r = ST.merge_override(_versions(spark, sf_dir), "o_orderkey")
    return r.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"), "src_idx")


@register("sorted_merge", """
WITH u AS (SELECT o_orderkey, o_totalprice, 0 AS src_idx FROM orders
           UNION ALL SELECT o_orderkey, o_totalprice * 1.1, 1 FROM orders WHERE o_orderkey % 2 = 0
           UNION ALL SELECT o_orderkey, o_totalprice * 0.9, 2 FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, src_idx,
       row_number() OVER (ORDER BY o_orderkey, src_idx) - 1 AS merged_pos
FROM u
""")
def sorted_merge(spark, sf_dir):
    r = ST.merged_ranks(_versions(spark, sf_dir), "o_orderkey", "o_orderkey")
    return r.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"), "src_idx", "merged_pos")


@register("missing_ids", """
WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem),
c AS (SELECT unnest(generate_series(lo, hi)) AS missing_id FROM b)
SELECT missing_id FROM c WHERE missing_id NOT IN (SELECT l_orderkey FROM lineitem)
""")
def missing_ids(spark, sf_dir):
    return ST.missing_ids(load(spark, sf_dir, "lineitem"), "l_orderkey")


@register("missing_ids_keyed", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) - DATE '1970-01-01' AS day FROM events),
b AS (SELECT user_id, unnest(generate_series(min(day), max(day))) AS day FROM d GROUP BY user_id)
SELECT b.user_id, CAST(b.day AS BIGINT) AS missing_id FROM b LEFT JOIN d ON d.user_id = b.user_id AND d.day = b.day WHERE d.day IS NULL
""")
def missing_ids_keyed(spark, sf_dir):
    """The days without an event between a user's first and last."""
    ev = load(spark, sf_dir, "events").select("user_id", F.unix_date(F.to_date("ts")).alias("day"))
    return ST.missing_ids(ev, "day", keys="user_id")


@register("missing_value", """
SELECT user_id, pos AS missing_value FROM (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS pos,
         row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS r
  FROM events) t
WHERE r = 1
""")
def missing_value(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    pos = S.with_position(ev, "user_id", "ts")
    top = ev.groupBy("user_id").agg(F.max_by("event_id", F.struct("value", "event_id")).alias("event_id"))
    arr = pos.join(top, ["user_id", "event_id"], "left_anti")
    return ST.missing_value(arr, "user_id", "pos")


# --- slots -----------------------------------------------------------------------

_TODAY = "2024-01-03"
_REQ_SQL = f"""r AS (SELECT event_id, user_id AS doctor_id, CAST(ts AS DATE) AS day, ts FROM events),
c AS (SELECT *, CASE WHEN doctor_id NOT IN (SELECT c_custkey FROM customer) THEN 'not_found'
                     WHEN day < DATE '{_TODAY}' THEN 'bad_request' END AS s0 FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY doctor_id, day ORDER BY ts, event_id) AS rk
      FROM c WHERE s0 IS NULL)"""


def _allocate(spark, sf_dir):
    """Every event asks its user for a slot on its day; the users known are those among the customers."""
    requests = load(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("doctor_id"), F.to_date("ts").alias("day"), "ts")
    known = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doctor_id"))
    return SL.allocate_slots(requests, "doctor_id", "day", "ts", "event_id", known, _TODAY)


@register("allocate_slots", f"""
WITH {_REQ_SQL}
SELECT event_id, doctor_id, day, CASE WHEN rk <= 32 THEN 'ok' ELSE 'conflict' END AS status,
       CASE WHEN rk <= 32 THEN rk - 1 END AS slot,
       CASE WHEN rk <= 32 THEN CAST(day AS TIMESTAMP) + to_minutes(CAST(540 + 15 * (rk - 1) AS BIGINT)) END AS slot_start
FROM k
UNION ALL
SELECT event_id, doctor_id, day, s0, NULL, NULL FROM c WHERE s0 IS NOT NULL
""")
def allocate_slots(spark, sf_dir):
    return _allocate(spark, sf_dir).select("event_id", "doctor_id", "day", "status", "slot", "slot_start")


@register("free_slots", f"""
WITH {_REQ_SQL},
d AS (SELECT doctor_id, day, count(*) AS n FROM k GROUP BY doctor_id, day),
g AS (SELECT doctor_id, day, n, unnest(generate_series(0, 31)) AS slot FROM d)
SELECT doctor_id, day, slot FROM g WHERE slot >= n
""")
def free_slots(spark, sf_dir):
    a = _allocate(spark, sf_dir).filter(F.col("status").isin("ok", "conflict"))
    return SL.free_slots(a, "doctor_id", "day")


_REPLAY = """
WITH RECURSIVE l AS (
    SELECT event_id, {doctor} AS doctor_id, CAST(ts AS DATE) AS day, ts,
           CASE WHEN event_type = 'error' THEN 'cancel' ELSE 'book' END AS op,
           CASE WHEN event_type = 'error' THEN CAST(props->>'k' AS BIGINT) % 34 END AS slot,
           row_number() OVER (PARTITION BY {doctor}, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
    FROM events),
r(doctor_id, day, rn, taken, status, result_slot) AS (
    SELECT DISTINCT doctor_id, day, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT) FROM l
    UNION ALL
    SELECT doctor_id, day, rn,
           CASE WHEN status = 'ok' AND op = 'book' THEN list_append(taken, pick)
                WHEN status = 'ok' THEN [x FOR x IN taken IF x <> pick] ELSE taken END,
           status, CASE WHEN status = 'ok' THEN pick END
    FROM (SELECT l.doctor_id, l.day, l.rn, taken, op,
                 CASE WHEN op = 'book' THEN list_min([x FOR x IN range(32) IF NOT list_contains(taken, x)]) ELSE slot END AS pick,
                 CASE WHEN op = 'book' THEN CASE WHEN len(taken) < 32 THEN 'ok' ELSE 'conflict' END
                      WHEN slot IS NULL OR slot NOT BETWEEN 0 AND 31 THEN 'bad_request'
                      WHEN list_contains(taken, slot) THEN 'ok' ELSE 'not_found' END AS status
          FROM r JOIN l ON l.doctor_id = r.doctor_id AND l.day = r.day AND l.rn = r.rn + 1) s)
"""

SLOT_REPLAY = _REPLAY.replace("{doctor}", "user_id")  # a user is a doctor: the stream's log


@register("slots_with_cancels", _REPLAY.replace("{doctor}", "user_id % 3") + """
SELECT event_id, l.doctor_id, l.day, ts, op, slot, status, result_slot
FROM l JOIN r ON l.doctor_id = r.doctor_id AND l.day = r.day AND l.rn = r.rn
""")
def slots_with_cancels(spark, sf_dir):
    """Every event books or cancels at one of three doctors, whose days fill up: slots run out, come free and are booked again."""
    ev = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    log = ev.select("event_id", (F.col("user_id") % 3).alias("doctor_id"), F.to_date("ts").alias("day"), "ts",
                    F.when(F.col("event_type") == "error", "cancel").otherwise("book").alias("op"),
                    F.when(F.col("event_type") == "error", k % 34).alias("slot"))
    return SL.slots_with_cancels(log, "doctor_id", "day", ["ts", "event_id"])


# --- folds -------------------------------------------------------------------------

_ORD = ["o_orderdate", "o_orderkey"]


@register("max_nonadjacent_sum", """
WITH RECURSIVE o AS (SELECT o_custkey, o_totalprice AS v,
                            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                     FROM orders),
r(o_custkey, rn, a, b) AS (
    SELECT o_custkey, rn, greatest(v, 0::DOUBLE), 0::DOUBLE FROM o WHERE rn = 1
    UNION ALL
    SELECT r.o_custkey, o.rn, greatest(r.a, r.b + o.v), r.a
    FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.rn = r.rn + 1)
SELECT o_custkey, round(arg_max(a, rn), 6) AS max_nonadjacent_sum FROM r GROUP BY o_custkey
""")
def max_nonadjacent_sum(spark, sf_dir):
    r = FO.max_nonadjacent_sum(load(spark, sf_dir, "orders"), "o_custkey", _ORD, "o_totalprice")
    return r.select("o_custkey", r6("max_nonadjacent_sum").alias("max_nonadjacent_sum"))


@register("longest_increasing", """
WITH RECURSIVE s AS (SELECT o_custkey, o_totalprice AS v,
                            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                     FROM orders),
r(o_custkey, rn, vs, ls) AS (
    SELECT o_custkey, rn, [v], [1] FROM s WHERE rn = 1
    UNION ALL
    SELECT r.o_custkey, s.rn, list_append(r.vs, s.v),
           list_append(r.ls, 1 + list_max(list_transform(range(1, len(r.vs) + 1),
                                          lambda i: CASE WHEN r.vs[i] < s.v THEN r.ls[i] ELSE 0 END)))
    FROM r JOIN s ON s.o_custkey = r.o_custkey AND s.rn = r.rn + 1)
SELECT o_custkey, CAST(max(list_max(ls)) AS BIGINT) AS lis_length FROM r GROUP BY o_custkey
""")
def longest_increasing(spark, sf_dir):
    return FO.longest_increasing(load(spark, sf_dir, "orders"), "o_custkey", _ORD, "o_totalprice")


@register("token_bucket", """
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t,
                            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r(user_id, rn, event_id, t, tokens, allowed) AS (
    SELECT user_id, rn, event_id, t, 2::DOUBLE, true FROM e WHERE rn = 1
    UNION ALL
    SELECT e.user_id, e.rn, e.event_id, e.t,
           CASE WHEN least(3::DOUBLE, CASE WHEN e.t > r.t THEN r.tokens + (e.t - r.t) / 1e6 * (1 / 43200) ELSE r.tokens END) >= 1
                THEN least(3::DOUBLE, CASE WHEN e.t > r.t THEN r.tokens + (e.t - r.t) / 1e6 * (1 / 43200) ELSE r.tokens END) - 1
                ELSE least(3::DOUBLE, CASE WHEN e.t > r.t THEN r.tokens + (e.t - r.t) / 1e6 * (1 / 43200) ELSE r.tokens END) END,
           least(3::DOUBLE, CASE WHEN e.t > r.t THEN r.tokens + (e.t - r.t) / 1e6 * (1 / 43200) ELSE r.tokens END) >= 1
    FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
SELECT user_id, event_id, allowed, round(tokens, 6) AS remaining, round((3::DOUBLE - tokens) / (1 / 43200), 6) AS reset_seconds
FROM r
""")
def token_bucket(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.lit(1).alias("permits"))
    r = RL.token_bucket(ev, "user_id", "ts", "permits", rate=1 / 43200, capacity=3.0, tie="event_id")
    return r.select("user_id", "event_id", "allowed", "remaining", "reset_seconds")


# A look asks for nothing (a peek), a purchase for two permits, anything else for one.
PERMITS = "CASE event_type WHEN 'view' THEN 0 WHEN 'purchase' THEN 2 ELSE 1 END"

_FILLED = "least(3, tokens + greatest(t - last, 0) / 1e6 * (1 / 43200))"

MIXED_BUCKET = f"""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t,
                            {PERMITS} AS permits,
                            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r(user_id, rn, event_id, tokens, last, seen, allowed) AS (
    SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), 3::DOUBLE, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), true FROM e
    UNION ALL
    SELECT user_id, rn, event_id, CASE WHEN have >= permits THEN have - permits ELSE have END, greatest(t, last),
           CASE WHEN permits > 0 THEN t WHEN fresh THEN NULL ELSE seen END, have >= permits
    FROM (SELECT *, CASE WHEN fresh THEN 3::DOUBLE ELSE {_FILLED} END AS have
          FROM (SELECT e.*, r.tokens, r.last, r.seen, r.seen IS NULL OR (e.t - r.seen) / 1e6 > 86400 AS fresh
                FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1) a) b)
SELECT user_id, event_id, allowed, round(tokens, 6) AS remaining, round((3::DOUBLE - tokens) / (1 / 43200), 6) AS reset_seconds
FROM r WHERE rn > 0
"""


@register("token_bucket_mixed", MIXED_BUCKET)
def token_bucket_mixed(spark, sf_dir):
    """Peeks, requests for several permits, and buckets that end a day after their last request."""
    ev = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.expr(PERMITS).alias("permits"))
    r = RL.token_bucket(ev, "user_id", "ts", "permits", rate=1 / 43200, capacity=3.0, idle_ttl=86400, tie="event_id")
    return r.select("user_id", "event_id", "allowed", "remaining", "reset_seconds")
