"""Sequence, window and interval bindings.

events: K=user_id, O=ts (unique), v=floor(value) as BIGINT;
orders: K=o_custkey, O=(o_orderdate, o_orderkey), v=o_totalprice.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import r6
from ..operators import intervals as I
from ..operators import sequences as S
from ..sources import load
from . import register

_O = ["o_orderdate", "o_orderkey"]

# DuckDB prelude shared by the event-series oracles
_S = """s AS (SELECT user_id, ts, event_type, CAST(floor(value) AS BIGINT) AS v,
                row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS pos
         FROM events)"""
_IV = """iv AS (SELECT user_id, ts AS start_ts,
                 ts + to_hours(CAST(1 + floor(value) AS BIGINT)) AS end_ts FROM events)"""


def events_v(spark, sf_dir):
    return load(spark, sf_dir, "events").withColumn("v", F.floor("value").cast("bigint"))


def events_iv(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.select("user_id", F.col("ts").alias("start_ts"),
                     F.expr("timestampadd(HOUR, CAST(1 + floor(value) AS INT), ts)").alias("end_ts"))


@register("max_gain", """
SELECT o_custkey, round(greatest(coalesce(max(o_totalprice - pm), 0), 0), 6) AS max_gain
FROM (SELECT o_custkey, o_totalprice,
             min(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
      FROM orders) t
GROUP BY o_custkey
""")
def max_gain(spark, sf_dir):
    r = S.max_gain(load(spark, sf_dir, "orders"), "o_custkey", _O, "o_totalprice")
    return r.select("o_custkey", r6("max_gain").alias("max_gain"))


@register("fill_depth", f"""
WITH {_S}
SELECT user_id, CAST(sum(least(lm, rm) - v) AS BIGINT) AS fill_depth
FROM (SELECT user_id, v,
             max(v) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lm,
             max(v) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rm
      FROM s) t
GROUP BY user_id
""")
def fill_depth(spark, sf_dir):
    r = S.fill_depth(events_v(spark, sf_dir), "user_id", "ts", "v")
    return r.select("user_id", F.col("fill_depth").cast("bigint"))


@register("max_span_pair", f"""
WITH {_S}
SELECT a.user_id, max(least(a.v, b.v) * (b.pos - a.pos)) AS max_span
FROM s a JOIN s b ON a.user_id = b.user_id AND a.pos < b.pos
GROUP BY a.user_id
""")
def max_span_pair(spark, sf_dir):
    return S.max_span_pair(events_v(spark, sf_dir), "user_id", "ts", "v")


@register("pair_sum", f"""
WITH {_S},
m AS (SELECT b.user_id, b.pos AS j, max(a.pos) AS i
      FROM s a JOIN s b ON a.user_id = b.user_id AND a.pos < b.pos AND a.v + b.v = 100
      GROUP BY b.user_id, b.pos)
SELECT user_id, arg_min(i, j) AS i_pos, min(j) AS j_pos FROM m GROUP BY user_id
""")
def pair_sum(spark, sf_dir):
    return S.pair_sum(events_v(spark, sf_dir), "user_id", "ts", "v", 100)


@register("position_of", f"""
WITH {_S},
t AS (SELECT DISTINCT user_id, CASE WHEN event_type = 'purchase' THEN v ELSE v + 1000 END AS target
      FROM s WHERE event_type IN ('purchase', 'error'))
SELECT t.user_id, t.target, coalesce(min(s.pos), -1) AS position
FROM t LEFT JOIN s ON s.user_id = t.user_id AND s.v = t.target
GROUP BY t.user_id, t.target
""")
def position_of(spark, sf_dir):
    ev = events_v(spark, sf_dir)
    targets = (ev.filter(F.col("event_type").isin("purchase", "error"))
                 .select("user_id", F.when(F.col("event_type") == "purchase", F.col("v"))
                                     .otherwise(F.col("v") + 1000).alias("target"))
                 .distinct())
    return S.position_of(ev, "user_id", "ts", "v", targets)


@register("misplaced_count", f"""
WITH {_S}
SELECT user_id, count(*) FILTER (WHERE pos < np AND v % 2 <> 0) AS misplaced
FROM (SELECT *, count(*) FILTER (WHERE v % 2 = 0) OVER (PARTITION BY user_id) AS np FROM s) t
GROUP BY user_id
""")
def misplaced_count(spark, sf_dir):
    ev = events_v(spark, sf_dir).withColumn("even", F.col("v") % 2 == 0)
    return S.misplaced_count(ev, "user_id", "ts", "even")


@register("rollover_point", """
WITH s AS (SELECT user_id, CAST(hour(ts) AS BIGINT) AS v,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS pos,
                  CAST(lag(hour(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS pv
           FROM events)
SELECT user_id, coalesce(min(pos) FILTER (WHERE v < pv), 0) AS rollover_pos,
       coalesce(arg_min(v, pos) FILTER (WHERE v < pv), arg_min(v, pos)) AS rollover_value,
       count(*) FILTER (WHERE v < pv) AS wraps
FROM s GROUP BY user_id
""")
def rollover_point(spark, sf_dir):
    ev = load(spark, sf_dir, "events").withColumn("hv", F.hour("ts").cast("bigint"))
    return S.rollover_point(ev, "user_id", "ts", "hv")


@register("longest_distinct_run", f"""
WITH {_S},
t AS (SELECT user_id, pos,
             coalesce(lag(pos) OVER (PARTITION BY user_id, event_type ORDER BY pos) + 1, 0) AS st
      FROM s),
u AS (SELECT user_id, pos, max(st) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS lft
      FROM t)
SELECT user_id, max(pos - lft + 1) AS longest_run FROM u GROUP BY user_id
""")
def longest_distinct_run(spark, sf_dir):
    return S.longest_distinct_run(load(spark, sf_dir, "events"), "user_id", "ts", "event_type")


@register("min_covering_span", """
WITH s AS (SELECT user_id, row_number() OVER w - 1 AS pos,
                  CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS is_s,
                  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_p,
                  sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER w AS cs,
                  sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w AS cp
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)),
c AS (SELECT a.user_id, a.pos AS span_start, b.pos AS span_end, b.pos - a.pos + 1 AS span_len
      FROM s a JOIN s b ON a.user_id = b.user_id AND a.pos <= b.pos
      WHERE b.cs - a.cs + a.is_s >= 1 AND b.cp - a.cp + a.is_p >= 2)
SELECT user_id, span_start, span_end, span_len
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY span_len, span_start) AS rn FROM c) t
WHERE rn = 1
""")
def min_covering_span(spark, sf_dir):
    return S.min_covering_span(load(spark, sf_dir, "events"), "user_id", "ts", "event_type",
                               {"signup": 1, "purchase": 2})


@register("next_greater", f"""
WITH {_S}
SELECT a.user_id, a.pos, a.v, coalesce(min(b.pos) - a.pos, 0) AS steps
FROM s a LEFT JOIN s b ON a.user_id = b.user_id AND b.pos > a.pos AND b.v > a.v
GROUP BY a.user_id, a.pos, a.v
""")
def next_greater(spark, sf_dir):
    return S.next_greater(events_v(spark, sf_dir), "user_id", "ts", "v")


@register("max_rectangle", f"""
WITH {_S},
n AS (SELECT user_id, count(*) AS n FROM s GROUP BY user_id),
r AS (SELECT a.user_id, a.pos, a.v,
             min(CASE WHEN b.pos > a.pos THEN b.pos END) AS rp,
             max(CASE WHEN b.pos < a.pos THEN b.pos END) AS lp
      FROM s a LEFT JOIN s b ON a.user_id = b.user_id AND b.v < a.v
      GROUP BY a.user_id, a.pos, a.v)
SELECT r.user_id, max(r.v * (coalesce(rp, n.n) - coalesce(lp, -1) - 1)) AS max_rectangle
FROM r JOIN n USING (user_id) GROUP BY r.user_id
""")
def max_rectangle(spark, sf_dir):
    return S.max_rectangle(events_v(spark, sf_dir), "user_id", "ts", "v")


@register("reverse_order", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS pos,
       row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) - 1 AS rev_pos
FROM events
""")
def reverse_order(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return S.reverse_order(S.with_position(ev, "user_id", "ts"), "user_id", "ts").drop("ts")


@register("merge_intervals", f"""
WITH {_IV},
m AS (SELECT *, max(end_ts) OVER (PARTITION BY user_id ORDER BY start_ts, end_ts
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM iv),
g AS (SELECT *, sum(CASE WHEN pm IS NULL OR start_ts > pm THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS isl
      FROM m)
SELECT user_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts FROM g GROUP BY user_id, isl
""")
def merge_intervals(spark, sf_dir):
    return I.merge_intervals(events_iv(spark, sf_dir), "user_id", "start_ts", "end_ts")


@register("max_concurrency", f"""
WITH {_IV},
ev AS (SELECT user_id, start_ts AS t, 1 AS d FROM iv UNION ALL SELECT user_id, end_ts, -1 FROM iv)
SELECT user_id, CAST(max(o) AS BIGINT) AS max_concurrency
FROM (SELECT user_id, sum(d) OVER (PARTITION BY user_id ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS o
      FROM ev) t
GROUP BY user_id
""")
def max_concurrency(spark, sf_dir):
    return I.max_concurrency(events_iv(spark, sf_dir), "user_id", "start_ts", "end_ts")


@register("min_removals", f"""
WITH RECURSIVE {_IV},
o AS (SELECT user_id, start_ts, end_ts,
             row_number() OVER (PARTITION BY user_id ORDER BY end_ts, start_ts) AS rn FROM iv),
r(user_id, rn, last_e, kept) AS (
    SELECT user_id, rn, end_ts, 1 FROM o WHERE rn = 1
    UNION ALL
    SELECT r.user_id, o.rn,
           CASE WHEN o.start_ts >= r.last_e THEN o.end_ts ELSE r.last_e END,
           r.kept + CASE WHEN o.start_ts >= r.last_e THEN 1 ELSE 0 END
    FROM r JOIN o ON o.user_id = r.user_id AND o.rn = r.rn + 1)
SELECT user_id, CAST(max(rn) - max(kept) AS BIGINT) AS min_removals FROM r GROUP BY user_id
""")
def min_removals(spark, sf_dir):
    return I.min_removals(events_iv(spark, sf_dir), "user_id", "start_ts", "end_ts")
