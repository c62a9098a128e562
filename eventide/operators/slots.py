"""Resource-day slot allocation (32 x 15-minute slots from 09:00)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import sorted_fold
from .scan import checked_broadcast, running

# Fixed values (must match the reference): 32 slots of 15 minutes from 09:00.
N_SLOTS = 32
DAY_START_MIN = 9 * 60
SLOT_MIN = 15


def slot_start(day, slot) -> F.Column:
    """Timestamp (NTZ) of a slot's start on a day."""
    return F.expr(f"timestampadd(MINUTE, {DAY_START_MIN} + {SLOT_MIN} * ({slot}), "
                  f"CAST({day} AS TIMESTAMP_NTZ))")


def allocate_slots(req: DataFrame, resource: str, day: str, ts: str, tie: str,
                   valid_resources: DataFrame, today, n_slots: int = N_SLOTS) -> DataFrame:
    """k-th valid request of a (resource, day) gets slot k-1.

    Checks in order: unknown resource -> 'not_found', day before ``today``
    -> 'bad_request', no free slot -> 'conflict', else 'ok' with slot and
    start time.  Only 'ok' requests consume a slot (no cancels here).
    """
    known = valid_resources.select(F.col(resource).alias("_r")).distinct().withColumn("_known", F.lit(True))
    known_b, _ = checked_broadcast(known)
    r = req.join(known_b, req[resource] == F.col("_r"), "left").drop("_r")
    status0 = (F.when(F.col("_known").isNull(), "not_found")
                .when(F.col(day) < F.lit(today).cast("date"), "bad_request"))
    r = r.withColumn("_status0", status0)
    ok = r.filter(F.col("_status0").isNull())
    ranked = running(ok, [resource, day], [ts, tie], {"_k": ("count", "_k")})
    ranked = ranked.withColumn("slot", F.when(F.col("_k") <= n_slots, F.col("_k") - 1))
    ranked = ranked.withColumn("status", F.when(F.col("slot").isNull(), "conflict").otherwise("ok"))
    bad = r.filter(F.col("_status0").isNotNull()).withColumn("status", F.col("_status0")) \
           .withColumn("slot", F.lit(None).cast("bigint"))
    out = ranked.drop("_k").unionByName(bad, allowMissingColumns=True)
    return (out.withColumn("slot_start", F.when(F.col("slot").isNotNull(), slot_start(day, "slot")))
               .drop("_known", "_status0"))


def free_slots(bookings: DataFrame, resource: str, day: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Slots not booked per (resource, day) that has bookings: generated
    grid anti-joined with the booked slots."""
    days = bookings.select(resource, day).distinct()
    grid = (days.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(n_slots - 1))))
                .withColumn("slot", F.col("slot").cast("bigint")))
    taken = bookings.filter(F.col("slot").isNotNull()).select(resource, day, F.col("slot").cast("bigint"))
    return grid.join(taken, [resource, day, "slot"], "left_anti")


def slots_with_cancels(log: DataFrame, resource: str, day: str, order, n_slots: int = N_SLOTS) -> DataFrame:
    """Replay book/cancel requests per (resource, day) with a slot bitmask.

    log: (resource, day, order..., op in {'book','cancel'}, slot for cancels).
    book -> lowest free slot or 'conflict'; cancel of an index outside
    [0, n_slots) -> 'bad_request'; cancel of a free slot -> 'not_found'.
    The log is streamed per key in order (state = one int per key).
    """
    def step(state, row):
        mask = state or 0
        if row["op"] == "book":
            for i in range(n_slots):
                if not mask >> i & 1:
                    return mask | (1 << i), ("ok", i)
            return mask, ("conflict", None)
        s = row["slot"]
        if s is None or s != s or s < 0 or s >= n_slots:
            return mask, ("bad_request", None)
        s = int(s)
        if not mask >> s & 1:
            return mask, ("not_found", None)
        return mask & ~(1 << s), ("ok", s)

    return sorted_fold(log, [resource, day], order, step,
                       [("status", "string"), ("result_slot", "bigint")])
