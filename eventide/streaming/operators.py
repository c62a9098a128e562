"""Streaming operators.

Event time: the driver tables carry TIMESTAMP_NTZ, which ``withWatermark``
rejects, so streams cast it to TIMESTAMP (session time zone UTC) on the
way in and back to NTZ on the way out.

Rows of a key inside one micro-batch are processed in event-time order; the
state of a key is small and bounded (a 5-minute deque, a token count, a slot
mask, a value with expiry).  A call into Python costs far more than a row, so sliding
windows, token buckets and slots group the keys by hash: a call takes the rows of
a group's keys, and its state lists those keys that still matter.  Token buckets and key-value entries use
``transformWithState`` with event-time timers, which end their state; rows later
than the watermark allows are left out there.  The others use
``applyInPandasWithState``, where such rows are processed in arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions import cols, r6
from ..operators.ratelimit import request, validate


def event_time(sdf: DataFrame, ts: str, watermark: str | None = "10 minutes") -> DataFrame:
    s = sdf.withColumn(ts, F.col(ts).cast("timestamp"))
    return s.withWatermark(ts, watermark) if watermark else s


def velocity_windows(sdf: DataFrame, keys, ts: str, amount: str, size: str, slide: str | None = None) -> DataFrame:
    """Windowed count/sum/avg per key on a stream (tumbling or hopping)."""
    k = cols(keys)
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = sdf.groupBy(*k, win.alias("_w")).agg(F.count(F.lit(1)).alias("txn_count"), F.sum(amount).alias("_s"))
    return g.select(*k, F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("_w.end").cast("timestamp_ntz").alias("window_end"), "txn_count",
                    r6("_s").alias("amount_sum"), r6(F.col("_s") / F.col("txn_count")).alias("amount_avg"))


GROUPS, DAY_GROUPS = 1024, 256  # of keys; of the keys of a day


def _grouped(sdf: DataFrame, key: str, groups: int) -> DataFrame:
    """Adds _group, a hash of the key; null keys have a group of their own, so a group's keys keep their type."""
    return sdf.withColumn("_group", F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")))


def _plain(values) -> list:
    """Keys of one group as Python values, None for null."""
    return [None if v is None or v != v else v for v in values.tolist()]


def _keyed(sdf: DataFrame, keys, fn, out_fields, state_schema: str, timeout: str = GroupStateTimeout.NoTimeout):
    out = T.StructType(out_fields)
    return sdf.groupBy(*cols(keys)).applyInPandasWithState(fn, out, state_schema, "append", timeout)


def sliding_velocity(sdf: DataFrame, key: str, ts: str, amount: str, window_seconds: float,
                     carry: Sequence[str] = ()) -> DataFrame:
    """Trailing-window count/sum as of each event.  The state of a group of keys holds the
    events of each key's last ``window_seconds``; a key goes when the watermark has passed them, the group with its last key."""
    w_us = int(window_seconds * 1_000_000)
    fields = [sdf.schema[c] for c in dict.fromkeys([*carry, key, ts, amount])]
    names = [f.name for f in fields]
    out_fields = fields + [T.StructField("trailing_count", T.LongType()),
                           T.StructField("trailing_amount_sum", T.DoubleType())]

    def ends(last_us):
        return int(last_us // 1000 + window_seconds * 1000) + 1

    def fn(k, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(pdfs), ignore_index=True)
        held = {}
        if state.exists:
            for one, t, a in zip(*state.get):
                held.setdefault(one, ([], []))
                held[one][0].append(t)
                held[one][1].append(a)
        codes, _ = pd.factorize(pdf[key], use_na_sentinel=False)
        us = pdf[ts].astype("datetime64[us]").astype("int64").to_numpy()
        order = np.lexsort((us, codes))  # stable
        pdf, us, codes = pdf.iloc[order], us[order], codes[order]
        amts = pdf[amount].to_numpy(dtype="float64")
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        cnts, sums = [], []
        for one, i, j in zip(_plain(pdf[key].iloc[first]), first.tolist(), [*first[1:].tolist(), len(us)]):
            if j - i == 1 and one not in held:
                cnts.append(1)
                sums.append(round(float(amts[i]), 6))
                held[one] = ([int(us[i])], [float(amts[i])])
                continue
            t_old, a_old = held.get(one, ((), ()))
            # all held and new rows in time order: a row's window ends with the rows of its own time
            t_all = np.concatenate((np.array(t_old, dtype="int64"), us[i:j]))
            a_all = np.concatenate((np.array(a_old, dtype="float64"), amts[i:j]))
            by_time = np.argsort(t_all, kind="stable")
            t_all, a_all = t_all[by_time], a_all[by_time]
            total = np.concatenate(([0.0], np.cumsum(a_all)))
            lo = np.searchsorted(t_all, us[i:j] - w_us, side="left")
            hi = np.searchsorted(t_all, us[i:j], side="right")
            cnts += (hi - lo).tolist()
            sums += [round(x, 6) for x in (total[hi] - total[lo]).tolist()]
            keep = t_all >= t_all[-1] - w_us
            held[one] = (t_all[keep].tolist(), a_all[keep].tolist())
        now = state.getCurrentWatermarkMs()
        live = [(one, t, a) for one, (ts_, as_) in held.items() if ends(ts_[-1]) > now for t, a in zip(ts_, as_)]
        if live:
            state.update(tuple(map(list, zip(*live))))
            state.setTimeoutTimestamp(max(ends(t) for _, t, _ in live))
        elif state.exists:
            state.remove()
        out = pdf[names].copy()
        out["trailing_count"] = cnts
        out["trailing_amount_sum"] = sums
        yield out

    kind = sdf.schema[key].dataType.simpleString()
    return _keyed(_grouped(sdf, key, GROUPS), "_group", fn, out_fields, f"k array<{kind}>, t array<long>, a array<double>",
                  GroupStateTimeout.EventTimeTimeout)


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _with_timers(sdf: DataFrame, key: str, processor: StatefulProcessor, out: T.StructType) -> DataFrame:
    """``processor`` over the rows of each key, with event-time timers; these need the RocksDB state store."""
    conf, name = sdf.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    if not (conf.get(name, "") or "").endswith("RocksDBStateStoreProvider"):
        conf.set(name, _ROCKSDB)
    return sdf.groupBy(key).transformWithStateInPandas(processor, outputStructType=out, outputMode="Append", timeMode="EventTime")


class _Buckets(StatefulProcessor):
    """The buckets of a group of clients, each held until it is full again or idle: from then on it equals no bucket at all."""

    def __init__(self, client, kind, ts, permits, order, names, rate, capacity, idle_ttl):
        self.client, self.kind, self.ts, self.permits, self.order, self.names = client, kind, ts, permits, order, names
        self.rate, self.capacity, self.idle_ttl = rate, capacity, idle_ttl

    def init(self, handle):
        self.handle = handle
        self.buckets = handle.getValueState("buckets", f"client array<{self.kind}>, tokens array<double>, last array<long>, "
                                                       "seen array<long>, until array<long>")

    def _until(self, b) -> int:
        """Milliseconds of event time after which the bucket tells no more than a new one (a second to spare for rounding)."""
        full = b[1] // 1000 + int((self.capacity - b[0]) / self.rate * 1000) + 1000
        return full if self.idle_ttl is None else min(full, b[2] // 1000 + int(self.idle_ttl * 1000) + 1000)

    def _held(self) -> dict:
        """Client -> (bucket, until)."""
        if not self.buckets.exists():
            return {}
        return {c: ((x, last, seen), until) for c, x, last, seen, until in zip(*self.buckets.get())}

    def _keep(self, held: dict) -> None:
        if held:
            self.buckets.update(tuple(map(list, zip(*((c, *b, until) for c, (b, until) in held.items())))))
        elif self.buckets.exists():
            self.buckets.clear()

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        us = pdf[self.ts].astype("datetime64[us]").astype("int64").tolist()
        now = timerValues.getCurrentWatermarkInMs()
        held = {c: e for c, e in self._held().items() if e[1] > now}
        state = {c: b for c, (b, _) in held.items()}
        clients = _plain(pdf[self.client])
        if self.kind in ("tinyint", "smallint", "int", "bigint"):  # beside another group's null they arrive as floats
            clients = [None if c is None else int(c) for c in clients]
        got = []
        for c, t, p in zip(clients, us, pdf[self.permits].tolist()):
            state[c], allowed, tokens = request(state.get(c), t, p, self.rate, self.capacity, self.idle_ttl)
            got.append((allowed, round(tokens, 6), round((self.capacity - tokens) / self.rate, 6)))
        for c in set(clients):
            if state[c] is None:
                held.pop(c, None)
            else:
                held[c] = (state[c], self._until(state[c]))
        self._keep(held)
        if held:
            self.handle.registerTimer(max(until for _, until in held.values()))
        out = pdf[self.names].copy()
        out["allowed"], out["remaining"], out["reset_seconds"] = map(list, zip(*got))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # a later timer waits for those that stay
        now = expiredTimerInfo.getExpiryTimeInMs()
        self._keep({c: e for c, e in self._held().items() if e[1] > now})
        return iter(())

    def close(self):
        pass


def token_bucket_stream(sdf: DataFrame, client: str, ts: str, permits: str, rate: float, capacity: float,
                        idle_ttl: float | None = None, tie: str | None = None,
                        carry: Sequence[str] = ()) -> DataFrame:
    """Token bucket per client, on a stream with a watermark.

    A client leaves its group's state once its bucket is full again (or, with ``idle_ttl``, idle),
    with the group's next rows or timer, so state is held for active clients only.
    """
    validate(rate, capacity, idle_ttl)
    fields = [sdf.schema[c] for c in dict.fromkeys([*carry, client, ts, permits])]
    out = T.StructType([*fields, T.StructField("allowed", T.BooleanType()), T.StructField("remaining", T.DoubleType()),
                        T.StructField("reset_seconds", T.DoubleType())])
    buckets = _Buckets(client, sdf.schema[client].dataType.simpleString(), ts, permits, [ts, *([tie] if tie else [])],
                       [f.name for f in fields], rate, capacity, idle_ttl)
    return _with_timers(_grouped(sdf, client, GROUPS), "_group", buckets, out)


class _Entries(StatefulProcessor):
    """A key's value while it is live: deleted and lapsed keys hold no state."""

    def __init__(self, key, ts, seq):
        self.key, self.ts, self.seq = key, ts, seq

    def init(self, handle):
        self.handle = handle
        self.entry = handle.getValueState("entry", "value string, expires long")

    def _row(self, key, value, expires, present, as_of):
        return pd.DataFrame({self.key: [key[0]], "value": pd.Series([value], dtype=object),
                             "expires_us": pd.array([expires], dtype="Int64"), "present": [present], "as_of_us": [as_of]})

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True).sort_values([self.ts, self.seq], kind="stable")
        live = self.entry.exists()
        value, expires = self.entry.get() if live else (None, None)
        t = None
        us = pdf[self.ts].astype("datetime64[us]").astype("int64").tolist()
        for t, op, new, ttl in zip(us, pdf["op"].tolist(), pdf["value"].tolist(), pdf["ttl"].tolist()):
            if live and expires is not None and expires <= t:
                live = False
            until = None if ttl is None or ttl != ttl else t + int(round(ttl * 1e6))
            if op == "set":
                value, expires, live = new, until, True
            elif op == "del":
                live = False
            elif op == "expire" and live:
                expires = until
            if not live:
                value, expires = None, None
        if live:
            self.entry.update((value, expires))
            if expires is not None:
                self.handle.registerTimer(-(-expires // 1000))
        else:
            self.entry.clear()
        yield self._row(key, value, expires, live, t)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.entry.exists():
            _, expires = self.entry.get()
            if expires is not None and expires <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
                self.entry.clear()
                yield self._row(key, None, None, False, expires)

    def close(self):
        pass


def kv_stream(sdf: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """Key-value store maintained from a SET/DEL/EXPIRE log on a stream with a
    watermark: one output row per key and micro-batch with (value, expiry in
    epoch micros or null, present flag), and one when a key lapses; read the latest
    row per key as of a time.  State is held for live keys only."""
    out = T.StructType([sdf.schema[key], T.StructField("value", T.StringType()), T.StructField("expires_us", T.LongType()),
                        T.StructField("present", T.BooleanType()), T.StructField("as_of_us", T.LongType())])
    return _with_timers(sdf, key, _Entries(key, ts, seq), out)


def slots_stream(sdf: DataFrame, resource: str, day: str, ts: str, tie: str, n_slots: int = 32,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Streaming twin of ``slots_with_cancels``: the state of a day and a group of resources is their 32-bit masks."""
    fields = [sdf.schema[c] for c in dict.fromkeys([*carry, resource, day, ts, tie, "op", "slot"])]
    names = [f.name for f in fields]
    out_fields = fields + [T.StructField("status", T.StringType()), T.StructField("result_slot", T.LongType())]
    full = (1 << n_slots) - 1

    def fn(k, pdfs, state):
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values([ts, tie], kind="stable")
        masks = dict(zip(*state.get)) if state.exists else {}
        st, rs = [], []
        for who, op, s in zip(_plain(pdf[resource]), pdf["op"].tolist(), pdf["slot"].tolist()):
            mask = masks.setdefault(who, 0)
            status, slot = "ok", None
            if op == "book":
                if mask == full:
                    status = "conflict"
                else:
                    slot = (~mask & (mask + 1)).bit_length() - 1  # the lowest free one
                    masks[who] = mask | 1 << slot
            elif s is None or s != s or s < 0 or s >= n_slots:
                status = "bad_request"
            elif not mask >> int(s) & 1:
                status = "not_found"
            else:
                slot = int(s)
                masks[who] = mask & ~(1 << slot)
            st.append(status)
            rs.append(slot)
        state.update((list(masks), list(masks.values())))
        out = pdf[names].copy()
        out["status"] = st
        out["result_slot"] = pd.array(rs, dtype="Int64")
        yield out

    kind = sdf.schema[resource].dataType.simpleString()
    return _keyed(_grouped(sdf, resource, DAY_GROUPS), ["_group", day], fn, out_fields, f"who array<{kind}>, masks array<long>")
