"""Feature, scoring, evaluation and training bindings.

lineitem: class = (l_returnflag = 'R'), AUC score = l_discount.
embeddings: first 28 dims + constant amount 100.0, class = (label = 0).
events -> predictions: linear score of (value/100, hour/24); scoring
fails (null outputs) for 'error' events.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import r6
from ..operators import jobs as J
from ..operators import ml as M
from ..operators import search as SE
from ..sources import load
from ..sources.files import labeled_csv_source, write_labeled_csv
from ..session import scratch_path, staged
from . import register

_HIST_SCHEMA = "epoch long, train_loss double, rows long"

# Fixed demo model parameters (not learned): weights follow a simple rule.
LINEAR_W = [((i % 5) - 2) / 10.0 for i in range(M.INPUT_DIM)]
LINEAR_B = -0.25
EVENT_W = [1.5, -0.5]
EVENT_B = -3.0
AMOUNT = 100.0


SPLIT_SQL = """(row_number() OVER (ORDER BY CAST('0x' || substr(md5({id} || '|42'), 1, 15) AS BIGINT), {id})
    <= CAST(floor(count(*) OVER () * 0.2) AS BIGINT))"""


def embedded(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return M.assemble_features(e.withColumn("amount", F.lit(AMOUNT)), "embedding", "amount") \
        .withColumn("label", (F.col("label") == 0).cast("int"))


def scaled(spark, sf_dir):
    d = embedded(spark, sf_dir)
    mean, std = M.scaler_params(M.fit_scaler(d))
    return M.scale_features(d, mean, std)


_F_SQL = """f AS (SELECT vec_id, CAST(i - 1 AS INTEGER) AS i,
                  CASE WHEN i <= 28 THEN CAST(embedding[i] AS DOUBLE) ELSE 100.0::DOUBLE END AS x
           FROM embeddings, range(1, 30) t(i)),
p AS (SELECT i, avg(x) AS m, CASE WHEN stddev_pop(x) < 1e-8 THEN 1.0::DOUBLE ELSE stddev_pop(x) END AS s
      FROM f GROUP BY i),
z AS (SELECT vec_id, i, (x - m) / s AS z FROM f JOIN p USING (i))"""


@register("assemble_features", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS i,
       round(CASE WHEN i <= 28 THEN coalesce(CAST(embedding[i] AS DOUBLE), 0.0::DOUBLE) ELSE 100.0::DOUBLE END, 6) AS x
FROM embeddings, range(1, 30) t(i)
""")
def assemble_features(spark, sf_dir):
    d = embedded(spark, sf_dir)
    return d.select("vec_id", F.posexplode("features").alias("i", "x")).withColumn("x", r6("x"))


@register("fit_scaler", f"""
WITH t AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
           JOIN (SELECT o_orderkey, {SPLIT_SQL.format(id='o_orderkey')} AS is_test FROM orders) s ON l_orderkey = o_orderkey
           WHERE NOT is_test)
SELECT i, round(m, 6) AS mean, round(CASE WHEN s < 1e-8 THEN 1.0::DOUBLE ELSE s END, 6) AS std FROM (
  SELECT 0 AS i, avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM t UNION ALL
  SELECT 1, avg(l_extendedprice), stddev_pop(l_extendedprice) FROM t UNION ALL
  SELECT 2, avg(l_discount), stddev_pop(l_discount) FROM t UNION ALL
  SELECT 3, avg(l_tax), stddev_pop(l_tax) FROM t) u
""")
def fit_scaler(spark, sf_dir):
    """Mean and deviation of the lines of the orders in the training split."""
    orders = M.split_train_test(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.2, 42)
    li = load(spark, sf_dir, "lineitem").join(orders.filter(~F.col("is_test")), F.col("l_orderkey") == F.col("o_orderkey")) \
        .select(F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("features"))
    p = M.fit_scaler(li, dim=4)
    return p.select(F.posexplode(F.arrays_zip("mean", "std")).alias("i", "ms")) \
            .select("i", r6("ms.mean").alias("mean"), r6("ms.std").alias("std"))


@register("scale_features", f"WITH {_F_SQL} SELECT vec_id, i, round(z, 6) AS z FROM z")
def scale_features(spark, sf_dir):
    s = scaled(spark, sf_dir)
    return s.select("vec_id", F.posexplode("scaled").alias("i", "z")).withColumn("z", r6("z"))


_W_SQL = ", ".join(f"({i}, {w!r}::DOUBLE)" for i, w in enumerate(LINEAR_W))


@register("score", f"""
WITH {_F_SQL},
w AS (SELECT * FROM (VALUES {_W_SQL}) v(i, w)),
d AS (SELECT vec_id, sum(z * w) AS dot FROM z JOIN w USING (i) GROUP BY vec_id)
SELECT vec_id, round_even(1 / (1 + exp(-(dot + ({LINEAR_B})::DOUBLE))), 6) AS fraud_probability,
       1 / (1 + exp(-(dot + ({LINEAR_B})::DOUBLE))) > 0.5 AS is_fraud
FROM d
""")
def score(spark, sf_dir):
    return M.score_linear(scaled(spark, sf_dir), LINEAR_W, LINEAR_B).select(
        "vec_id", "fraud_probability", "is_fraud")


@register("score_batch", f"""
WITH {_F_SQL},
w AS (SELECT * FROM (VALUES {_W_SQL}) v(i, w)),
d AS (SELECT vec_id, sum(z * w) AS dot FROM z JOIN w USING (i) GROUP BY vec_id)
SELECT count(*) AS scored, count(*) FILTER (WHERE 1 / (1 + exp(-(dot + ({LINEAR_B})::DOUBLE))) > 0.5) AS flagged
FROM d
""")
def score_batch(spark, sf_dir):
    s = M.score_linear(scaled(spark, sf_dir), LINEAR_W, LINEAR_B)
    return s.agg(F.count(F.lit(1)).alias("scored"), F.count_if("is_fraud").alias("flagged"))


def network_sql(name: str, p) -> str:
    """A CTE with a network's weights: per layer the list of each unit's weights, and the biases."""
    cols = []
    for i in range(3):
        w, b = p[f"W{i}"].astype(float).T.tolist(), p[f"b{i}"].astype(float).tolist()
        cols += [f"{w}::DOUBLE[][] AS w{i}", f"{b}::DOUBLE[] AS b{i}"]
    return f"{name} AS (SELECT {', '.join(cols)})"


def forward_sql(z: str) -> str:
    """The probability that a network in scope (w0, b0, ...) gives the list of scaled features ``z``."""
    layer = lambda x, i: f"list_transform(range(1, len(b{i}) + 1), lambda j{i}: greatest(list_dot_product({x}, w{i}[j{i}]) + b{i}[j{i}], 0))"
    return f"1 / (1 + exp(-(list_dot_product({layer(layer(z, 0), 1)}, w2[1]) + b2[1])))"


@register("score_mlp", f"""
WITH {_F_SQL}, {network_sql('net', M.init_mlp(42))},
rows AS (SELECT vec_id, list(z ORDER BY i) AS x FROM z GROUP BY vec_id),
s AS (SELECT vec_id, {forward_sql('x')} AS p FROM rows, net)
SELECT vec_id, round_even(p, 6) AS fraud_probability, p > 0.5 AS is_fraud FROM s
""")
def score_mlp(spark, sf_dir):
    return M.score_mlp(scaled(spark, sf_dir), M.init_mlp(42), dtype=np.float64).select("vec_id", "fraud_probability", "is_fraud")


def event_predictions(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    feats = ev.withColumn("f", F.array(F.col("value") / F.lit(100.0), F.hour("ts") / F.lit(24.0)))
    s = M.score_linear(feats, EVENT_W, EVENT_B, features="f", valid=F.col("event_type") != "error")
    return s.select(F.col("event_id").cast("string").alias("transaction_id"),
                    F.col("user_id").cast("string").alias("account_id"),
                    F.col("value").alias("amount"), "ts", "event_id", "fraud_probability", "is_fraud")


_P_SQL = f"""pr AS (SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS account_id,
                   value AS amount, ts, event_id,
                   CASE WHEN event_type <> 'error' THEN 1 / (1 + exp(-((0::DOUBLE + (value / 100.0::DOUBLE) * {EVENT_W[0]}::DOUBLE
                        + (hour(ts) / 24.0::DOUBLE) * ({EVENT_W[1]})::DOUBLE) + ({EVENT_B})::DOUBLE))) END AS p
            FROM events)"""


@register("null_on_failure", f"""
WITH {_P_SQL}
SELECT transaction_id, account_id, amount, ts, event_id, round_even(p, 6) AS fraud_probability,
       p > 0.5 AS is_fraud FROM pr
""")
def null_on_failure(spark, sf_dir):
    return event_predictions(spark, sf_dir)


@register("recent_n", """
SELECT event_id, user_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 200
""")
def recent_n(spark, sf_dir):
    from ..operators.dashboard import recent_n as rn
    ev = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return rn(ev, ["ts", "event_id"], 200)


@register("dashboard_metrics", f"""
WITH {_P_SQL},
last AS (SELECT * FROM pr ORDER BY ts DESC, event_id DESC LIMIT 200)
SELECT count(*) AS rows_seen, count(*) FILTER (WHERE p > 0.5) AS flagged,
       round(coalesce(avg(round_even(p, 6)), 0.0::DOUBLE), 6) AS mean_probability
FROM last
""")
def dashboard_metrics(spark, sf_dir):
    from ..operators.dashboard import dashboard_metrics as dm
    return dm(event_predictions(spark, sf_dir), ["ts", "event_id"], 200)


@register("class_weight", """
SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS n_pos, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_neg,
       round(count(*) FILTER (WHERE l_returnflag <> 'R') / greatest(count(*) FILTER (WHERE l_returnflag = 'R'), 1), 6)
         AS pos_weight
FROM lineitem
""")
def class_weight(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    r = M.class_weight(li, "y")
    return r.select("n_pos", "n_neg", r6("pos_weight").alias("pos_weight"))


@register("roc_auc", """
WITH g AS (SELECT l_discount AS s, count(*) FILTER (WHERE l_returnflag = 'R') AS p,
                  count(*) FILTER (WHERE l_returnflag <> 'R') AS n FROM lineitem GROUP BY 1),
c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(CAST(sum(p * (below + 0.5 * n)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * sum(n)), 6) AS auc,
       round(CAST(sum(p * (below + n)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * sum(n)), 6) AS auc_ties_as_one,
       CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(n) AS BIGINT) AS n_neg
FROM c
""")
def roc_auc(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_discount", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    a = M.roc_auc(li, "l_discount", "y", tie_credits=(0.5, 1.0))
    return a.select(r6("auc_0").alias("auc"), r6("auc_1").alias("auc_ties_as_one"),
                    F.col("n_pos").cast("bigint"), F.col("n_neg").cast("bigint"))


@register("split_train_test", f"SELECT o_orderkey, {SPLIT_SQL.format(id='o_orderkey')} AS is_test FROM orders")
def split_train_test(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    return M.split_train_test(o, "o_orderkey", 0.2, 42)


@register("labeled_csv_source", """
SELECT round(list_sum([coalesce(CAST(x AS DOUBLE), 0) * i FOR x, i IN embedding[1:28]]) + 100.0 * 29, 4) AS weighted,
       29 AS n_features, CASE WHEN label = 0 THEN 1 ELSE 0 END AS label
FROM embeddings
""")
def labeled_csv_source_q(spark, sf_dir):
    """Written as CSV and read back: each row's features, weighted by their place, and its label."""
    d = embedded(spark, sf_dir)
    path = scratch_path(spark, "labeled_csv")
    write_labeled_csv(d, path)
    got = labeled_csv_source(spark, path)
    weighted = F.expr("aggregate(transform(features, (x, i) -> x * (i + 1)), 0D, (a, x) -> a + x)")
    return got.select(F.round(weighted, 4).alias("weighted"), F.size("features").alias("n_features"), F.col("label").cast("int").alias("label"))


@register("train_linear")
def train_linear(spark, sf_dir):
    """Scaler and weights from the training split, AUC on the held-out rows."""
    rows = M.split_train_test(embedded(spark, sf_dir).select("vec_id", "features", "label"), "vec_id", 0.2, 42)
    mean, std = M.scaler_params(M.fit_scaler(rows.filter(~F.col("is_test"))))
    s = staged(M.scale_features(rows, mean, std))  # each iteration reads them
    w, b = M.train_linear(s.filter(~F.col("is_test")))
    auc = M.roc_auc(M.score_linear(s.filter("is_test"), w, b), "fraud_probability", "label")
    return auc.select("auc", "n_pos", "n_neg", F.lit(b).alias("intercept"))


@register("train_mlp")
def train_mlp(spark, sf_dir):
    s = staged(scaled(spark, sf_dir))  # each step reads them
    _p, hist = M.train_mlp(s, epochs=15)
    return spark.createDataFrame(hist, _HIST_SCHEMA)


@register("checkpoint_resume")
def checkpoint_resume(spark, sf_dir):
    s = staged(scaled(spark, sf_dir))
    root = scratch_path(spark, "train_ckpt")
    M.train_mlp(s, epochs=8, ckpt_dir=root)
    _p, hist = M.train_mlp(s, epochs=15, ckpt_dir=root)  # resumes at 9
    return spark.createDataFrame(hist, _HIST_SCHEMA)


# --- search and jobs ---------------------------------------------------------------

for _name, _budget in (("min_feasible_rate", 100), ("min_feasible_rate_tight", 60)):
    _sql = f"""
WITH s AS (SELECT user_id, CAST(floor(value) AS BIGINT) AS v FROM events),
m AS (SELECT user_id, max(v) AS mx FROM s GROUP BY user_id),
k AS (SELECT user_id, mx, unnest(generate_series(1, greatest(mx, 1))) AS k FROM m),
f AS (SELECT k.user_id, k.k, k.mx, sum((s.v + k.k - 1) // k.k) AS hours
      FROM k JOIN s USING (user_id) GROUP BY 1, 2, 3)
SELECT user_id, CAST(coalesce(min(k) FILTER (WHERE hours <= {_budget}), greatest(max(mx), 1)) AS BIGINT) AS rate
FROM f GROUP BY user_id
"""

    def _q(spark, sf_dir, _budget=_budget):
        ev = load(spark, sf_dir, "events").select("user_id", F.floor("value").cast("bigint").alias("v"))
        return SE.min_feasible_rate(ev, "user_id", "v", _budget)
    register(_name, _sql)(_q)


def desired(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job"),
                                                 (F.col("o_orderkey") % 4 + 1).cast("int").alias("worker_count"))


def observed(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("job"), (F.col("l_linenumber") - 1).cast("bigint").alias("rank")) \
             .agg(F.count_if(F.col("l_returnflag") == "A").alias("succeeded"),
                  F.count_if(F.col("l_returnflag") == "R").alias("failed"),
                  F.count_if(F.col("l_linestatus") == "O").alias("active"),
                  F.max(F.col("l_quantity").cast("bigint")).alias("last_checkpoint_epoch"))


_OBS_SQL = """obs AS (SELECT l_orderkey AS job, CAST(l_linenumber - 1 AS BIGINT) AS rank,
                      count(*) FILTER (WHERE l_returnflag = 'A') AS succeeded,
                      count(*) FILTER (WHERE l_returnflag = 'R') AS failed,
                      count(*) FILTER (WHERE l_linestatus = 'O') AS active,
                      max(CAST(floor(l_quantity) AS BIGINT)) AS epoch
               FROM lineitem GROUP BY 1, 2),
cls AS (SELECT *, CASE WHEN succeeded > 0 THEN 'Succeeded' WHEN failed >= 3 THEN 'Failed'
                       WHEN active = 0 THEN 'Pending' ELSE 'Running' END AS phase FROM obs),
want AS (SELECT o_orderkey AS job, CAST(unnest(generate_series(0, o_orderkey % 4)) AS BIGINT) AS rank FROM orders),
rec AS (SELECT want.job, want.rank,
               CASE WHEN cls.phase IS NULL THEN 'create' WHEN cls.phase = 'Failed' THEN 'recreate' ELSE 'keep' END AS action,
               CASE WHEN cls.phase IS NULL THEN 'Pending' WHEN cls.phase = 'Failed' THEN 'Resuming' ELSE cls.phase END AS phase,
               coalesce(cls.failed, 0) AS restart_count, coalesce(cls.epoch, 0) AS last_checkpoint_epoch
        FROM want LEFT JOIN cls ON want.job = cls.job AND want.rank = cls.rank)"""


@register("classify_status", f"""
WITH {_OBS_SQL}
SELECT job, rank, succeeded, failed, active, phase, failed AS restart_count FROM cls
""")
def classify_status(spark, sf_dir):
    return J.classify_status(observed(spark, sf_dir)).drop("last_checkpoint_epoch")


@register("reconcile", f"WITH {_OBS_SQL} SELECT * FROM rec")
def reconcile(spark, sf_dir):
    return J.reconcile(desired(spark, sf_dir), observed(spark, sf_dir))


@register("status_rollup", f"""
WITH {_OBS_SQL}
SELECT job, CASE WHEN bool_and(phase = 'Succeeded') THEN 'Succeeded' WHEN bool_or(phase = 'Failed') THEN 'Failed'
                 WHEN bool_or(phase = 'Resuming') THEN 'Resuming' WHEN bool_and(phase = 'Pending') THEN 'Pending'
                 ELSE 'Running' END AS phase,
       coalesce(min(last_checkpoint_epoch), 0) AS current_epoch, count(*) AS workers
FROM rec GROUP BY job
""")
def status_rollup(spark, sf_dir):
    return J.status_rollup(J.reconcile(desired(spark, sf_dir), observed(spark, sf_dir)))


@register("shard_rows", "SELECT o_orderkey, CAST(o_orderkey % 3 AS INTEGER) AS shard FROM orders")
def shard_rows(spark, sf_dir):
    return J.shard_rows(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 3)
