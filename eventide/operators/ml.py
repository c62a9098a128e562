"""Feature preparation, scoring, evaluation and data-parallel training.

Scaler parameters and model weights are small, fixed-size objects (29
means/stds, 4,033 MLP weights): they are the only things that travel
through the driver, as literals or broadcast NumPy arrays.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_staged, staged
from .scan import global_prefix_sum, global_rank

# Fixed values (must match the reference): 28 features + amount, a 29-64-32-1
# network with dropout 0.2, std floor 1e-8; producer: 2 % outliers shifted by
# +-3.5, exponential amounts with scale 250 (1200 for outliers), 500 accounts,
# categories grocery, electronics, travel, gas, online, restaurant.
N_FEATURES = 28
INPUT_DIM = N_FEATURES + 1
HIDDEN = (64, 32)
DROPOUT = 0.2
STD_FLOOR = 1e-8
OUTLIER_RATE = 0.02
OUTLIER_SHIFT = 3.5
AMOUNT_SCALE = (250.0, 1200.0)
ACCOUNTS = 500
CATEGORIES = ("grocery", "electronics", "travel", "gas", "online", "restaurant")


# --- features -----------------------------------------------------------------

def assemble_features(df: DataFrame, arr: str, amount: str, out: str = "features") -> DataFrame:
    """First 28 entries of ``arr`` (zero-padded, as doubles) followed by ``amount``."""
    head = F.transform(F.sequence(F.lit(1), F.lit(N_FEATURES)),
                       lambda i: F.coalesce(F.get(F.col(arr), i - 1).cast("double"), F.lit(0.0)))
    return df.withColumn(out, F.concat(head, F.array(F.col(amount).cast("double"))))


def fit_scaler(df: DataFrame, features: str = "features", dim: int = INPUT_DIM) -> DataFrame:
    """Per-position mean and population std (std < 1e-8 -> 1.0): one row
    (mean array<double>, std array<double>) from a single aggregate."""
    aggs = []
    for i in range(dim):
        x = F.get(F.col(features), i)
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*aggs)
    std = [F.when(F.col(f"s{i}") < STD_FLOOR, F.lit(1.0)).otherwise(F.col(f"s{i}")) for i in range(dim)]
    return row.select(F.array(*[F.col(f"m{i}") for i in range(dim)]).alias("mean"),
                      F.array(*std).alias("std"))


def scaler_params(params: DataFrame) -> tuple[list[float], list[float]]:
    """Bring the (fixed-size) scaler to the driver."""
    r = params.first()
    return list(r["mean"]), list(r["std"])


def scale_features(df: DataFrame, mean: Sequence[float], std: Sequence[float],
                   features: str = "features", out: str = "scaled") -> DataFrame:
    """(x - mean) / std elementwise against literal parameter arrays."""
    m = F.array(*[F.lit(float(v)) for v in mean])
    s = F.array(*[F.lit(float(v)) for v in std])
    ms = F.arrays_zip(m.alias("m"), s.alias("s"))
    return df.withColumn(out, F.zip_with(F.col(features), ms, lambda x, p: (x - p["m"]) / p["s"]))


# --- scoring ------------------------------------------------------------------

def score_linear(df: DataFrame, weights: Sequence[float], bias: float, features: str = "scaled",
                 threshold: float = 0.5, valid: F.Column | None = None) -> DataFrame:
    """Logistic score as pure expressions.

    fraud_probability = bround(sigmoid(w.x + b), 6) (half-even, as the
    reference rounds); is_fraud compares the *unrounded* probability.
    Rows failing ``valid`` keep null probability and flag (null on failure).
    """
    w = F.array(*[F.lit(float(v)) for v in weights])
    dot = F.aggregate(F.zip_with(F.col(features), w, lambda a, b: a * b), F.lit(0.0), lambda acc, y: acc + y)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(dot + F.lit(float(bias)))))
    ok = valid if valid is not None else F.col(features).isNotNull()
    return (df.withColumn("_p", F.when(ok, p))
              .withColumn("fraud_probability", F.bround("_p", 6))
              .withColumn("is_fraud", F.col("_p") > F.lit(threshold))
              .drop("_p"))


def init_mlp(seed: int = 42) -> dict[str, np.ndarray]:
    """He-uniform style init of the 29-64-32-1 network (float32)."""
    rng = np.random.default_rng(seed)
    dims = [INPUT_DIM, *HIDDEN, 1]
    p = {}
    for i in range(3):
        bound = 1.0 / np.sqrt(dims[i])
        p[f"W{i}"] = rng.uniform(-bound, bound, (dims[i], dims[i + 1])).astype(np.float32)
        p[f"b{i}"] = rng.uniform(-bound, bound, (dims[i + 1],)).astype(np.float32)
    return p


def n_params(p: dict[str, np.ndarray]) -> int:
    return int(sum(v.size for v in p.values()))


def _forward(p, x):
    h1 = np.maximum(x @ p["W0"] + p["b0"], 0)
    h2 = np.maximum(h1 @ p["W1"] + p["b1"], 0)
    return (h2 @ p["W2"] + p["b2"])[:, 0], (h1, h2)


def _probability(p: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Scores of scaled rows, in double precision whatever the weights' own."""
    logit, _ = _forward({k: v.astype(np.float64) for k, v in p.items()}, x)
    return 1.0 / (1.0 + np.exp(-logit))


def score_versions(df: DataFrame, models: Sequence, ts: str, features: str = "features", threshold: float = 0.5) -> DataFrame:
    """Scores raw feature vectors by the model version that was in force at each row's event time.

    ``models`` (``sources.files.load_models``, bounded and broadcast) are in the order of their times.  Adds
    model_version, fraud_probability (6 places) and is_fraud; null for rows before the first version, without a
    time, or with a vector that is missing, short or holds a null.  Works on streams and tables alike.
    """
    bc = df.sparkSession.sparkContext.broadcast(list(models))
    schema = T.StructType([*df.schema.fields, T.StructField("model_version", T.LongType()),
                           T.StructField("fraud_probability", T.DoubleType()), T.StructField("is_fraud", T.BooleanType())])
    micros = "_valid_us"

    def fn(batches):
        held = bc.value
        starts = np.array([int(m.valid_from.replace(tzinfo=m.valid_from.tzinfo or datetime.timezone.utc).timestamp() * 1_000_000)
                           for m in held], np.int64)
        for pdf in batches:
            ok = pdf[features].map(lambda a: a is not None and len(a) == INPUT_DIM).to_numpy(dtype=bool)
            at = pdf[micros]
            which = np.where(at.isna(), -1, np.searchsorted(starts, at.fillna(0).to_numpy(dtype=np.int64), side="right") - 1)
            prob = np.full(len(pdf), np.nan)
            for i in np.unique(which[ok & (which >= 0)]):
                rows = np.flatnonzero(ok & (which == i))
                x = np.stack([np.asarray(a, dtype=np.float64) for a in pdf[features].iloc[rows]])
                prob[rows] = _probability(held[i].params, (x - np.array(held[i].mean)) / np.array(held[i].std))
            scored = ok & (which >= 0) & ~np.isnan(prob)  # a null within a vector arrives as NaN
            out = pdf.drop(columns=micros)
            out["model_version"] = pd.array([held[i].version if s else None for i, s in zip(which, scored)], dtype="Int64")
            out["fraud_probability"] = pd.Series(np.round(prob, 6), index=pdf.index).where(scored, None)
            out["is_fraud"] = pd.Series(prob > threshold, index=pdf.index).where(scored, None)
            yield out

    return df.withColumn(micros, F.unix_micros(F.col(ts).cast("timestamp"))).mapInPandas(fn, schema)


def score_mlp(df: DataFrame, params: dict[str, np.ndarray], features: str = "scaled",
              threshold: float = 0.5, dtype: type = np.float32) -> DataFrame:
    """MLP forward pass per Arrow batch (one matmul chain per batch).

    Weights (4,033 floats) are broadcast once; dropout is off at scoring.
    Computed in ``dtype``; in single precision the sixth place depends on the
    order in which the machine adds.
    Rows with a missing/short feature vector get null outputs.
    """
    bc = df.sparkSession.sparkContext.broadcast({k: v for k, v in params.items()})
    schema = T.StructType([*df.schema.fields,
                           T.StructField("fraud_probability", T.DoubleType()),
                           T.StructField("is_fraud", T.BooleanType())])

    def fn(batches):
        p = bc.value
        for pdf in batches:
            feats = pdf[features]
            ok = feats.map(lambda a: a is not None and len(a) == INPUT_DIM).to_numpy(dtype=bool)
            prob = np.full(len(pdf), np.nan)
            if ok.any():
                x = np.stack([np.asarray(a, dtype=dtype) for a in feats[ok]])
                logit, _ = _forward({k: v.astype(dtype) for k, v in p.items()}, x)
                prob[ok] = 1.0 / (1.0 + np.exp(-logit.astype(np.float64)))
            out = pdf.copy()
            out["fraud_probability"] = pd.Series(np.where(ok, np.round(prob, 6), np.nan)).where(ok, None)
            out["is_fraud"] = pd.Series(prob > threshold).where(ok, None)
            yield out

    return df.mapInPandas(fn, schema)


# --- evaluation -----------------------------------------------------------------

def class_weight(df: DataFrame, y: str) -> DataFrame:
    """neg / max(pos, 1): the positive-class weight of the weighted loss."""
    return (df.agg(F.count_if(F.col(y) == 1).alias("n_pos"), F.count_if(F.col(y) == 0).alias("n_neg"))
              .withColumn("pos_weight", F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1))))


def roc_auc(df: DataFrame, score: str, y: str, tie_credit: float = 0.5,
            tie_credits: Sequence[float] | None = None) -> DataFrame:
    """Mann-Whitney AUC without pairs: per distinct score (pos, neg) counts,
    negatives below each score by a bucketed global prefix sum.

    A tie between a positive and a negative earns ``tie_credit`` (0.5 is the
    standard; the reference's loop counts 1.0).  With ``tie_credits`` the
    result has one column ``auc_<i>`` per credit.  Null when a class is absent.
    """
    credits = list(tie_credits) if tie_credits else [tie_credit]
    g = df.groupBy(score).agg(F.count_if(F.col(y) == 1).alias("_p"), F.count_if(F.col(y) == 0).alias("_n"))
    c = global_prefix_sum(g, [score], "_n", "_below")
    tot = c.agg(*[F.sum(F.col("_p") * (F.col("_below") + F.lit(t) * F.col("_n"))).alias(f"_u{i}")
                  for i, t in enumerate(credits)],
                F.sum("_p").alias("n_pos"), F.sum("_n").alias("n_neg"))
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    outs = [F.when(both, F.col(f"_u{i}") / (F.col("n_pos").cast("double") * F.col("n_neg")))
             .alias("auc" if not tie_credits else f"auc_{i}") for i in range(len(credits))]
    return tot.select(*outs, "n_pos", "n_neg")


def split_train_test(df: DataFrame, id_col: str, frac: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds is_test: exactly floor(n * frac) rows, those with the smallest hashes of (id, seed).

    The hash is the first 60 bits of an MD5, which every engine has.  The cut is found by radix selection: counts of
    the leading 12 bits tell which bucket holds the k-th smallest, the next round looks into that bucket alone,
    and after five rounds the k-th hash is known; nothing is sorted.  Rows with that very hash (equal ids, or a
    collision) are taken in the order of their ids.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"|{seed}")).cast("binary")), 1, 15),
               16, 10).cast("bigint")
    hashes = staged(df.select(h.alias("h")))  # alone, for the rounds
    n = hashes.count()
    k = int(n * frac)
    if not k:
        return df.withColumn("is_test", F.lit(False))
    prefix, rest = 0, k  # the k-th smallest hash begins with prefix, and is the rest-th of those that do
    for shift in range(48, -1, -12):
        inside = F.shiftright("h", shift + 12) == prefix
        counts = sorted(hashes.filter(inside).groupBy(F.shiftright("h", shift).alias("b")).count().collect())  # at most 4,096 rows
        for b, c in counts:
            if rest <= c:
                prefix = b
                break
            rest -= c
    last = hashes.filter(F.col("h") == prefix).count()
    drop_staged(hashes)
    if last == rest:
        return df.withColumn("is_test", h <= prefix)
    tied = global_rank(df.filter(h == prefix), [id_col], "_r").withColumn("is_test", F.col("_r") < rest).drop("_r")
    return df.filter(h != prefix).withColumn("is_test", h < prefix).unionByName(tied)


# --- training -------------------------------------------------------------------

def train_linear(df: DataFrame, features: str = "scaled", label: str = "label",
                 max_iter: int = 50) -> tuple[list[float], float]:
    """Weighted logistic regression (Spark ML) with pos weight = neg/pos."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    cw = class_weight(df, label).first()["pos_weight"]
    d = (df.withColumn("_v", array_to_vector(features))
           .withColumn("_w", F.when(F.col(label) == 1, F.lit(float(cw))).otherwise(F.lit(1.0)))
           .withColumn("_y", F.col(label).cast("double")))
    m = LogisticRegression(featuresCol="_v", labelCol="_y", weightCol="_w", maxIter=max_iter,
                           regParam=0.0).fit(d)
    return [float(v) for v in m.coefficients.toArray()], float(m.intercept)


def _flatten(p):
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _unflatten(v, like):
    out, i = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = v[i:i + n].reshape(like[k].shape).astype(np.float32)
        i += n
    return out


def _grad_partition(p, x, y, pos_weight, keep, rng):
    """Summed gradient of weighted BCE-with-logits over a partition's rows."""
    h0 = x @ p["W0"] + p["b0"]
    a1 = np.maximum(h0, 0)
    mask = (rng.random(a1.shape) >= DROPOUT).astype(np.float32) / (1 - DROPOUT) if keep else 1.0
    d1 = a1 * mask
    h1 = d1 @ p["W1"] + p["b1"]
    a2 = np.maximum(h1, 0)
    z = (a2 @ p["W2"] + p["b2"])[:, 0]
    sig = 1.0 / (1.0 + np.exp(-z))
    w = np.where(y == 1, pos_weight, 1.0)
    # d/dz of  w*y*softplus(-z) + (1-y)*softplus(z)
    dz = (w * y * (sig - 1.0) + (1.0 - y) * sig).astype(np.float32)[:, None]
    loss = float(np.sum(w * y * np.logaddexp(0, -z) + (1 - y) * np.logaddexp(0, z)))
    g = {"W2": a2.T @ dz, "b2": dz.sum(0)}
    da2 = dz @ p["W2"].T * (h1 > 0)
    g["W1"] = d1.T @ da2
    g["b1"] = da2.sum(0)
    dd1 = da2 @ p["W1"].T * mask * (h0 > 0)
    g["W0"] = x.T @ dd1
    g["b0"] = dd1.sum(0)
    return g, loss


_FIXED = float(1 << 32)  # of a gradient sum
_LARGEST = float(1 << 62)  # that such a sum may become


def _adam(p, m, v2, t, g, lr):
    """Adam's step ``t`` along ``g``, in place."""
    for k in p:
        m[k] = 0.9 * m[k] + 0.1 * g[k]
        v2[k] = 0.999 * v2[k] + 0.001 * g[k] ** 2
        mh = m[k] / (1 - 0.9 ** t)
        vh = v2[k] / (1 - 0.999 ** t)
        p[k] = (p[k] - lr * mh / (np.sqrt(vh) + 1e-8)).astype(np.float32)


def _epoch_of_steps(data: DataFrame, state: tuple, epoch: int, steps: int, lr: float, seed: int, pos_weight: float, workers: int):
    """An epoch of ``steps`` steps over rows (x, y, _h): (params, m, v, t, sum of losses, rows).

    The rows are dealt once, packed as float32: a step's rows to ``workers`` partitions of its own.  The job of a step
    runs these alone, so a row is read once an epoch.  A dropout mask belongs to an input partition and a step,
    as without ``batch_rows``, so the result doesn't depend on the dealing.  A loss or gradient that isn't finite, or
    too large for the fixed point, is an error.
    """
    spark = data.sparkSession
    p, m, v2, t = state
    rows = data.select("x", "y", F.pmod(F.xxhash64("_h", F.lit(epoch)), F.lit(steps)).alias("b"), F.spark_partition_id().alias("pid"))

    def pack(it):
        blocks, pid = {}, None
        for pdf in it:
            if not len(pdf):
                continue
            pid = int(pdf["pid"].iloc[0])
            x, y, step = np.stack([np.asarray(a, dtype=np.float32) for a in pdf["x"]]), pdf["y"].to_numpy(dtype=np.float32), pdf["b"].to_numpy()
            for b in np.unique(step):
                at = step == b
                blocks.setdefault(int(b), []).append((x[at], y[at]))
        for b, parts in blocks.items():
            yield pd.DataFrame({"b": [b], "pid": [pid], "x": [b"".join(x.tobytes() for x, _ in parts)],
                                "y": [b"".join(y.tobytes() for _, y in parts)]})

    dealt = rows.mapInPandas(pack, "b long, pid long, x binary, y binary").rdd \
        .map(lambda r: (r.b * workers + r.pid % workers, (r.pid, bytes(r.x), bytes(r.y)))).partitionBy(steps * workers, int)
    loss_sum, n_sum = 0.0, 0
    for b in range(steps):
        now = {k: a.copy() for k, a in p.items()}

        def gradient(it, now=now, b=b):
            total, most, loss, seen = np.zeros(n_params(now), np.int64), 0.0, 0.0, 0
            for _, (pid, x, y) in it:
                rng = np.random.default_rng([seed, epoch, b, pid])
                ys = np.frombuffer(y, np.float32)
                g, part = _grad_partition(now, np.frombuffer(x, np.float32).reshape(len(ys), -1), ys, pos_weight, True, rng)
                fixed = _flatten(g).astype(np.float64) * _FIXED
                most += float(np.abs(fixed).max())  # no sum is larger; NaN if any number is
                if most < _LARGEST:
                    total += np.rint(fixed).astype(np.int64)
                loss += part
                seen += len(ys)
            return [(total, most, loss, seen)]

        got = spark.sparkContext.runJob(dealt, gradient, range(b * workers, (b + 1) * workers))  # a vector of the model's size from each
        nb = sum(seen for *_, seen in got)
        if nb == 0:
            continue
        loss = sum(part for _, _, part, _ in got)
        if not (np.isfinite(loss) and sum(most for _, most, _, _ in got) < _LARGEST):
            raise ArithmeticError(f"epoch {epoch}, step {b}: the loss ({loss}) or a gradient isn't finite or is too large; "
                                  "a vector holds a null or no number, or the training diverged")
        loss_sum += loss
        n_sum += nb
        t += 1
        _adam(p, m, v2, t, _unflatten(sum(g for g, *_ in got) / _FIXED / nb, p), lr)
    return p, m, v2, t, loss_sum, n_sum


def train_mlp(df: DataFrame, features: str = "scaled", label: str = "label", epochs: int = 15,
              lr: float = 1e-3, batches_per_epoch: int = 4, seed: int = 42,
              ckpt_dir: str | None = None, ckpt_every: int = 5,
              params: dict | None = None, batch_rows: int | None = None, workers: int = 4) -> tuple[dict, list[dict]]:
    """Synchronous data-parallel training of the 29-64-32-1 MLP with Adam.

    Each step broadcasts the weights, every partition emits one summed
    gradient vector for its rows of the step's hash batch, the vectors
    are summed by a keyed aggregate over parameter index, and Adam runs on
    the driver (4,033 numbers).  With ``ckpt_dir`` the run resumes from
    the last complete checkpoint and writes one every ``ckpt_every``
    epochs and at the end; a resumed run gives what an unbroken one does, as
    gradients are summed in fixed point, whose sums depend on no order.  With
    ``batch_rows`` a step takes that many rows for each of ``workers`` workers, however
    many rows there are, instead of ``batches_per_epoch`` steps; its job then reads these
    rows alone, as reading all rows in each would take the square of their number.  Rows without a label
    have no loss and are left out there (a history's rows are those trained on); no row at all, or a number that isn't
    finite, is an error.  Returns (params, history).
    """
    from . import checkpoint as C

    spark = df.sparkSession
    pos_weight = float(class_weight(df, label).first()["pos_weight"])
    p = params or init_mlp(seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    t, start = 0, 1
    if ckpt_dir:
        st = C.load_latest(spark, ckpt_dir)
        if st is not None:
            p, m, v2, t, start = st["params"], st["m"], st["v"], st["t"], st["epoch"] + 1
    data = df.select(F.col(features).alias("x"), F.col(label).cast("double").alias("y"),
                     F.xxhash64(F.col(features).cast("string")).alias("_h"))
    if batch_rows:
        data = data.filter(F.col("y").isNotNull())
        n = data.count()
        if not n:
            raise ValueError("no row with a label to train on")
        batches_per_epoch = -(-n // (batch_rows * workers))
    history = []
    for epoch in range(start, epochs + 1):
        loss_sum, n_sum = 0.0, 0
        if batch_rows:
            p, m, v2, t, loss_sum, n_sum = _epoch_of_steps(data, (p, m, v2, t), epoch, batches_per_epoch, lr, seed, pos_weight, workers)
        for b in range(0 if batch_rows else batches_per_epoch):
            bc = spark.sparkContext.broadcast(p)
            batch = data.filter(F.pmod(F.xxhash64("_h", F.lit(epoch)), F.lit(batches_per_epoch)) == b)
            np_ = n_params(p)

            def part_grad(it, bc=bc, epoch=epoch, b=b, np_=np_):
                from pyspark import TaskContext

                pw = bc.value
                # seeded by (seed, epoch, batch, partition): independent dropout masks per
                # partition that a retried task reproduces exactly
                pid = TaskContext.get().partitionId() if TaskContext.get() else 0
                rng = np.random.default_rng([seed, epoch, b, pid])
                vec, loss, seen = np.zeros(np_), 0.0, 0
                for pdf in it:  # one Arrow batch in memory at a time
                    if len(pdf):
                        x = np.stack([np.asarray(a, dtype=np.float32) for a in pdf["x"]])
                        g, part = _grad_partition(pw, x, pdf["y"].to_numpy(dtype=np.float32), pos_weight, True, rng)
                        vec += _flatten(g)
                        loss += part
                        seen += len(pdf)
                if not seen:
                    return
                yield pd.DataFrame({"i": np.arange(np_, dtype=np.int64), "g": np.rint(vec * _FIXED).astype(np.int64),
                                    "loss": np.where(np.arange(np_) == 0, loss, 0.0),
                                    "n": np.where(np.arange(np_) == 0, seen, 0)})

            grads = (batch.select("x", "y").mapInPandas(part_grad, "i long, g long, loss double, n long")
                          .groupBy("i").agg(F.sum("g").alias("g"), F.sum("loss").alias("loss"),
                                            F.sum("n").alias("n")))
            rows = grads.toPandas().sort_values("i")  # one row per parameter: bounded by model size
            nb = int(rows["n"].sum())
            if nb == 0:
                continue
            gvec = rows["g"].to_numpy() / _FIXED / nb
            loss_sum += float(rows["loss"].sum())
            n_sum += nb
            g = _unflatten(gvec, p)
            t += 1
            _adam(p, m, v2, t, g, lr)
            bc.unpersist()
        history.append({"epoch": epoch, "train_loss": loss_sum / max(n_sum, 1), "rows": n_sum})
        if ckpt_dir and (epoch % ckpt_every == 0 or epoch == epochs):
            C.save(spark, ckpt_dir, epoch, {"params": p, "m": m, "v": v2, "t": t})
    return p, history


def synth_transactions(spark: SparkSession, n: int, seed: int = 42, accounts: int = ACCOUNTS) -> DataFrame:
    """Synthetic transactions in the producer's shape, generated in parallel.

    28 N(0,1) features; 2 % outliers shifted by +-3.5 per feature; amount
    exponential with scale 250 (1200 for outliers), 2 decimals half-even.
    """
    cats = F.array(*[F.lit(c) for c in CATEGORIES])
    base = spark.range(n).withColumn("_u", F.rand(seed))
    out = base.withColumn("_out", F.col("_u") < OUTLIER_RATE)
    shift = F.when(F.col("_out"), F.lit(OUTLIER_SHIFT)).otherwise(F.lit(0.0))
    feats = F.array(*[F.randn(seed + 1 + i) + shift * F.when(F.rand(seed + 101 + i) < 0.5, -1.0).otherwise(1.0)
                      for i in range(N_FEATURES)])
    scale = F.when(F.col("_out"), F.lit(AMOUNT_SCALE[1])).otherwise(F.lit(AMOUNT_SCALE[0]))
    return out.select(
        F.format_string("txn_%010d", F.col("id")).alias("transaction_id"),
        F.format_string("acct_%04d", (F.floor(F.rand(seed + 200) * accounts) + 1).cast("int")).alias("account_id"),
        (F.timestamp_seconds(F.lit(1704067200) + F.col("id"))).alias("timestamp"),
        F.bround(-scale * F.log1p(-F.rand(seed + 300)), 2).alias("amount"),
        F.element_at(cats, (F.floor(F.rand(seed + 400) * len(CATEGORIES)) + 1).cast("int")).alias("merchant_category"),
        feats.alias("features"),
        F.col("_out").cast("int").alias("_simulated_label"))
