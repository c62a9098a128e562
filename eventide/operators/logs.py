"""Operation logs and key-value change logs.

Op log schema: (entity, seq, op, item, key, value) with op in
{'add', 'remove', 'update'}; add/remove use ``item``, update uses
``key``/``value``.  Last-writer-wins replaces sequential replay: the final
state only depends on the last op per (entity, item) and (entity, key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cols
from .scan import running


def fold_operations(log: DataFrame, entity: str = "entity", seq: str = "seq",
                    initial: DataFrame | None = None) -> DataFrame:
    """Final state per entity after applying the log in ``seq`` order, in
    long form: (entity, kind, name, value) with kind 'item' (value null)
    for each item in the set and kind 'meta' for each metadata key.

    ``initial`` (entity, item) seeds items that no later op touches.  An
    entity's state is never gathered into one value (it can be large).
    """
    e = cols(entity)
    item_ops = log.filter(F.col("op").isin("add", "remove"))
    last_item = (item_ops.groupBy(*e, "item")
                         .agg(F.max_by("op", F.col(seq)).alias("_last")))
    if initial is not None:
        seeded = initial.select(*e, "item").join(last_item.select(*e, "item"), [*e, "item"], "left_anti")
        last_item = last_item.unionByName(seeded.withColumn("_last", F.lit("add")))
    items = last_item.filter(F.col("_last") == "add").select(
        *e, F.lit("item").alias("kind"), F.col("item").alias("name"), F.lit(None).cast("string").alias("value"))
    meta = (log.filter(F.col("op") == "update")
               .groupBy(*e, "key").agg(F.max_by("value", F.col(seq)).alias("value"))
               .select(*e, F.lit("meta").alias("kind"), F.col("key").alias("name"), "value"))
    return items.unionByName(meta)


def compact_log(log: DataFrame, entity: str = "entity", seq: str = "seq") -> DataFrame:
    """Collapse runs of adjacent updates to the same key into the last one."""
    e = cols(entity)
    nxt = running(log.withColumn("_okey", F.when(F.col("op") == "update", F.col("key"))),
                  e, [seq], {"_next_key": ("last", "_okey")}, reverse=True, exclusive=True)
    drop = (F.col("op") == "update") & F.col("_next_key").isNotNull() & (F.col("_next_key") == F.col("key"))
    return nxt.filter(~drop).drop("_okey", "_next_key")


def batch_adds(log: DataFrame, entity: str = "entity", seq: str = "seq") -> DataFrame:
    """Reorder a compacted log so adds move ahead of every op they commute with.

    An add only stops behind the latest earlier remove of the same item
    (its anchor).  Adds sharing an anchor end up newest-first right after
    it, the order the stable bubble pass produces.  Adds a 0-based
    ``new_pos`` per entity.
    """
    e = cols(entity)
    rm = log.withColumn("_rm", F.when(F.col("op") == "remove", F.col(seq)))
    anch = running(rm, e, [seq], {"_anchor_rm": ("max", "_rm")}, by="item", exclusive=True)
    is_add = F.col("op") == "add"
    keyed = (anch.withColumn("_anchor", F.when(is_add, F.coalesce("_anchor_rm", F.lit(-1)))
                                          .otherwise(F.col(seq)))
                 .withColumn("_is_add", is_add.cast("int"))
                 .withColumn("_neg", -F.col(seq)))
    pos = running(keyed, e, ["_anchor", "_is_add", "_neg"], {"_c": ("count", "_c")})
    return (pos.withColumn("new_pos", F.col("_c") - 1)
               .drop("_rm", "_anchor_rm", "_anchor", "_is_add", "_neg", "_c"))


def remove_n(df: DataFrame, keys, pos: str, v: str, target, count: int) -> DataFrame:
    """LREM: drop up to |count| rows equal to ``target`` from the head
    (count > 0) or tail (count < 0); count = 0 drops all.  Returns the
    remaining rows."""
    k = cols(keys)
    hit = df.withColumn("_hit", (F.col(v) == F.lit(target)).cast("int"))
    if count == 0:
        return hit.filter(F.col("_hit") == 0).drop("_hit")
    r = running(hit.filter(F.col("_hit") == 1), k, [pos], {"_n": ("count", "_n")}, reverse=count < 0)
    gone = r.filter(F.col("_n") <= abs(count)).select(*k, pos)
    return hit.join(gone, [*k, pos], "left_anti").drop("_hit")


def hot_keys(log: DataFrame, key: str, ts: str, capacity: int) -> DataFrame:
    """Keys an LRU of ``capacity`` holds after the access log: the most
    recently touched keys (partial+final max, then a top-k)."""
    return (log.groupBy(key).agg(F.max(ts).alias("last_access"))
               .orderBy(F.col("last_access").desc(), F.col(key)).limit(capacity))


def first_unique(df: DataFrame, key: str, order) -> DataFrame:
    """The earliest key that occurs exactly once (one row; null if none)."""
    o = cols(order)
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                              F.min(F.struct(*[F.col(c) for c in o])).alias("_first"))
    once = per.filter(F.col("_n") == 1)
    return once.agg(F.min_by(key, "_first").alias("first_unique_key"),
                    F.min("_first").getField(o[0]).alias("first_seen"))


def kv_snapshot(log: DataFrame, as_of, key: str = "key", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Live keys of a SET/DEL/EXPIRE log at ``as_of`` (timestamp literal).

    log: (key, ts, seq, op in {'set','del','expire'}, value, ttl seconds or null).
    SET replaces value and expiry (no TTL clears it); EXPIRE on a missing or
    expired key is ignored, which makes every EXPIRE after the first lapse
    a no-op, so validity is a property of consecutive pairs (a lag).
    Returns key, value, ttl_seconds (-1 when there is no expiry).
    """
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    asof_us = F.unix_micros(F.lit(as_of).cast("timestamp"))
    base = (log.filter(F.col(ts) <= F.lit(as_of))
               .withColumn("_t", us(ts))
               .withColumn("_exp", F.when(F.col("ttl").isNotNull(),
                                          F.col("_t") + F.round(F.col("ttl") * 1e6).cast("bigint"))))
    last_sd = (base.filter(F.col("op").isin("set", "del"))
                   .groupBy(key).agg(F.max_by(F.struct("op", "value", "_t", seq, "_exp"),
                                              F.struct("_t", seq)).alias("_s")))
    live = last_sd.filter(F.col("_s.op") == "set").select(
        key, F.col("_s.value").alias("value"), F.col("_s._t").alias("_st"),
        F.col(f"_s.{seq}").alias("_sseq"), F.col("_s._exp").alias("_sexp"))
    ex = (base.filter(F.col("op") == "expire").join(live.select(key, "_st", "_sseq", "_sexp"), key)
              .filter(F.struct("_t", seq) > F.struct(F.col("_st"), F.col("_sseq")))
              .select(key, "_t", seq, "_exp"))
    seed = live.select(key, F.col("_st").alias("_t"), F.col("_sseq").alias(seq), F.col("_sexp").alias("_exp"))
    chain = running(seed.withColumn("_is_seed", F.lit(1)).unionByName(ex.withColumn("_is_seed", F.lit(0))),
                    key, ["_t", seq], {"_pexp": ("last", "_exp")}, exclusive=True)
    # a lapse: the previous op had an expiry at or before this EXPIRE
    lapse = (F.col("_is_seed") == 0) & F.col("_pexp").isNotNull() & (F.col("_pexp") <= F.col("_t"))
    fin = chain.groupBy(key).agg(F.max(lapse.cast("int")).alias("_lapsed"),
                                 F.max_by("_exp", F.struct("_t", seq)).alias("_fexp"))
    out = (live.join(fin, key)
               .filter((F.col("_lapsed") == 0) & (F.col("_fexp").isNull() | (F.col("_fexp") > asof_us))))
    return out.select(key, "value",
                      F.when(F.col("_fexp").isNull(), F.lit(-1.0))
                       .otherwise(F.round((F.col("_fexp") - asof_us) / 1e6, 6)).alias("ttl_seconds"))
