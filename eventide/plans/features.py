"""Velocity and feature bindings on ``events`` (account=user_id, amount=value)."""

from __future__ import annotations

from ..operators import velocity as V
from ..sources import load
from . import register

_EV = ("event_id",)

_TUMBLE_SQL = """
SELECT user_id, window_start, window_start + INTERVAL {iv} AS window_end,
       count(*) AS txn_count, round(sum(value), 6) AS amount_sum,
       round(sum(value) / count(*), 6) AS amount_avg
FROM (SELECT user_id, value,
             time_bucket(INTERVAL {iv}, ts, TIMESTAMP '1970-01-01') AS window_start
      FROM events) t
GROUP BY user_id, window_start
"""

for _name, _size, _iv in (("velocity_tumbling", "5 minutes", "5 MINUTE"),
                          ("velocity_tumbling_1h", "1 hour", "1 HOUR"),
                          ("velocity_tumbling_1d", "1 day", "1 DAY")):
    def _q(spark, sf_dir, _size=_size):
        return V.velocity_tumbling(load(spark, sf_dir, "events"), "user_id", "ts", "value", _size)
    register(_name, _TUMBLE_SQL.format(iv=_iv))(_q)


@register("velocity_hopping", """
SELECT user_id, s AS window_start, s + INTERVAL 1 HOUR AS window_end,
       count(*) AS txn_count, round(sum(value), 6) AS amount_sum,
       round(sum(value) / count(*), 6) AS amount_avg
FROM (SELECT user_id, value, ts,
             unnest([time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') - INTERVAL 15 MINUTE * i
                     FOR i IN range(4)]) AS s
      FROM events) t
GROUP BY user_id, s
""")
def velocity_hopping(spark, sf_dir):
    return V.velocity_tumbling(load(spark, sf_dir, "events"), "user_id", "ts", "value",
                               "1 hour", "15 minutes")


_ENRICH_SQL = """
SELECT event_id, user_id, ts, value, window_start,
       count(*) OVER w AS win_count,
       round(sum(value) OVER w, 6) AS win_amount_sum,
       round(sum(value) OVER w / count(*) OVER w, 6) AS win_amount_avg
FROM (SELECT *, time_bucket(INTERVAL {iv}, ts, TIMESTAMP '1970-01-01') AS window_start
      FROM events) t
WINDOW w AS (PARTITION BY user_id, window_start)
"""

for _name, _size, _iv in (("velocity_enrich", "5 minutes", "5 MINUTE"),
                          ("velocity_enrich_1h", "1 hour", "1 HOUR")):
    def _q(spark, sf_dir, _size=_size):
        return V.velocity_enrich(load(spark, sf_dir, "events"), "user_id", "ts", "value",
                                 _size, carry=_EV)
    register(_name, _ENRICH_SQL.format(iv=_iv))(_q)


_SLIDE_SQL = """
SELECT event_id, user_id, ts, value,
       count(*) OVER w AS trailing_count,
       round(sum(value) OVER w, 6) AS trailing_amount_sum
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN INTERVAL {iv} PRECEDING AND CURRENT ROW)
"""

for _name, _size, _bucket, _iv in (("velocity_sliding", "5 minutes", None, "5 MINUTE"),
                                   ("velocity_sliding_1d", "1 day", "1 day", "1 DAY")):
    def _q(spark, sf_dir, _size=_size, _bucket=_bucket):
        return V.velocity_sliding(load(spark, sf_dir, "events"), "user_id", "ts", "value",
                                  _size, bucket=_bucket, carry=_EV)
    register(_name, _SLIDE_SQL.format(iv=_iv))(_q)
