"""Token-bucket rate limiting replayed over a request log (batch form).

Per client: the bucket starts full at the first request; before each
request it refills by elapsed_seconds * rate, capped at ``capacity``; a
request is allowed if tokens >= permits and then consumes them, a denied
request consumes nothing.  ``permits = 0`` is a peek: it reports what is there,
creates no bucket and is no access.  With ``idle_ttl`` (seconds) a client whose
last access is longer ago than that gets a fresh full bucket (the in-memory
limiter evicts idle buckets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import sorted_fold
from .scan import PIECE, running, split


def validate(rate: float, capacity: float, idle_ttl: float | None) -> None:
    if not rate > 0:
        raise ValueError("rate must be positive")
    if not capacity > 0:
        raise ValueError("capacity must be positive")
    if idle_ttl is not None and not idle_ttl > 0:
        raise ValueError("idle_ttl must be positive")


Bucket = tuple[float, int, int]  # tokens, time of the last refill, time of the last access (microseconds)


def request(bucket: Bucket | None, t: int, permits: float, rate: float, capacity: float,
            idle_ttl: float | None) -> tuple[Bucket | None, bool, float]:
    """(bucket after a request at time t, whether it is allowed, tokens left)."""
    if permits is None or permits < 0:
        raise ValueError("permits must be >= 0")
    if bucket is None or (idle_ttl is not None and (t - bucket[2]) / 1e6 > idle_ttl):
        if permits == 0:
            return None, True, float(capacity)
        bucket = (float(capacity), t, t)
    tokens, last, seen = bucket
    elapsed = (t - last) / 1e6
    if elapsed > 0:
        tokens, last = min(capacity, tokens + elapsed * rate), t
    if permits > 0:
        seen = t
    allowed = tokens >= permits
    if allowed:
        tokens -= permits
    return (tokens, last, seen), bool(allowed), tokens


def token_bucket(df: DataFrame, client: str, ts: str, permits: str, rate: float,
                 capacity: float, idle_ttl: float | None = None, tie: str | None = None) -> DataFrame:
    """Adds allowed, remaining, reset_seconds per request.

    A pause in which the bucket fills up again, whatever was in it, parts a client's requests into
    runs that know nothing of each other: each run is replayed by itself, so a busy client is
    spread over tasks.  What is replayed in a row is one run.
    """
    validate(rate, capacity, idle_ttl)
    base = df.withColumn("_t_us", F.unix_micros(F.col(ts).cast("timestamp")))
    order = ["_t_us"] + ([tie] if tie else [])
    pieces = split(base, client, order)
    full = int(capacity / rate * 1e6) + 1_000_000  # a second to spare for rounding
    timed = running(pieces.df, client, order, {"_before": ("last", "_t_us")}, exclusive=True, pieces=pieces)
    timed = timed.withColumn("_new", F.coalesce(F.col("_t_us") - F.col("_before") >= full, F.lit(True)).cast("int"))
    base = running(timed, client, order, {"_run": ("sum", "_new")}, pieces=pieces).drop("_before", "_new", PIECE)

    def step(st, r):
        st, allowed, tokens = request(st, r["_t_us"], r[permits], rate, capacity, idle_ttl)
        return st, (allowed, round(tokens, 6), round((capacity - tokens) / rate, 6))

    out = sorted_fold(base, [client, "_run"], order, step,
                      [("allowed", "boolean"), ("remaining", "double"), ("reset_seconds", "double")])
    return out.drop("_t_us", "_run")
