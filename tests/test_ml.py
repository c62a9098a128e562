"""Feature, scoring, evaluation and training checks against NumPy references."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.operators import ml as M
from eventide.sources import files as FS


def test_assemble_and_scale(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 5.0), (2, [float(i) for i in range(40)], 7.0)],
                               "id int, arr array<double>, amount double")
    a = {r.id: r.features for r in M.assemble_features(df, "arr", "amount").collect()}
    assert a[1] == [1.0, 2.0] + [0.0] * 26 + [5.0]
    assert a[2] == [float(i) for i in range(28)] + [7.0]
    p = M.fit_scaler(M.assemble_features(df, "arr", "amount"))
    mean, std = M.scaler_params(p)
    assert mean[2] == 1.0 and std[2] == 1.0  # (0, 2) -> mean 1, pop std 1
    assert std[3] == 1.5 and mean[3] == 1.5
    x = np.array([a[1], a[2]])
    assert np.allclose(mean, x.mean(0)) and np.allclose(std, np.where(x.std(0) < 1e-8, 1.0, x.std(0)))


def test_score_linear_rounding_and_nulls(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [100.0]), (3, None)], "id int, f array<double>")
    r = {x.id: x for x in M.score_linear(df, [1.0], 0.0, features="f").collect()}
    assert r[1].fraud_probability == 0.5 and r[1].is_fraud is False  # strict > on the unrounded value
    assert r[2].fraud_probability == 1.0 and r[2].is_fraud is True
    assert r[3].fraud_probability is None and r[3].is_fraud is None


def test_score_mlp_matches_numpy(spark):
    p = M.init_mlp(3)
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(20, M.INPUT_DIM)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(99, [1.0])],
                               "id int, scaled array<double>")
    got = {r.id: r.fraud_probability for r in M.score_mlp(df, p).collect()}
    logit, _ = M._forward(p, x)
    want = np.round(1 / (1 + np.exp(-logit.astype(np.float64))), 6)
    assert all(abs(got[i] - want[i]) < 1e-6 for i in range(20))
    assert got[99] is None
    assert M.n_params(p) == 4033


def test_roc_auc_vs_pairs(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([0.1, 0.2, 0.3, 0.4]), rnd.randint(0, 1)) for _ in range(300)]
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    for credit in (0.5, 1.0):
        want = sum(1.0 if p > n else credit if p == n else 0.0 for p, n in itertools.product(pos, neg))
        want /= len(pos) * len(neg)
        df = spark.createDataFrame(rows, "s double, y int")
        got = M.roc_auc(df, "s", "y", credit).first()["auc"]
        assert abs(got - want) < 1e-12
    one = spark.createDataFrame([(0.1, 1)], "s double, y int")
    assert M.roc_auc(one, "s", "y").first()["auc"] is None


def test_class_weight_and_split(spark):
    df = spark.createDataFrame([(i, 1 if i % 10 == 0 else 0) for i in range(1000)], "id long, y int")
    cw = M.class_weight(df, "y").first()
    assert (cw.n_pos, cw.n_neg, cw.pos_weight) == (100, 900, 9.0)
    s = M.split_train_test(df, "id", 0.2, 42)
    assert s.filter("is_test").count() == 200
    assert s.filter("is_test").select("id").collect() == M.split_train_test(df, "id", 0.2, 42) \
        .filter("is_test").select("id").collect()


def test_csv_roundtrip_and_missing(spark, tmp_path):
    df = spark.createDataFrame([([float(i)] * 29, i % 2) for i in range(10)], "features array<double>, label int")
    FS.write_labeled_csv(df, str(tmp_path / "csv"))
    back = FS.labeled_csv_source(spark, str(tmp_path / "csv"))
    assert sorted((r.features[0], r.label) for r in back.collect()) == sorted((float(i), i % 2) for i in range(10))
    with pytest.raises(FileNotFoundError):
        FS.labeled_csv_source(spark, str(tmp_path / "nope"))


def test_train_mlp_and_resume(spark, tmp_path):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(400, M.INPUT_DIM))
    y = (x[:, 0] + x[:, 1] > 1.0).astype(int)
    df = spark.createDataFrame([([float(v) for v in row], int(t)) for row, t in zip(x, y)],
                               "scaled array<double>, label int")
    _p, hist = M.train_mlp(df, epochs=6, lr=1e-2, batches_per_epoch=2)
    assert hist[-1]["train_loss"] < hist[0]["train_loss"]
    root = str(tmp_path / "ckpt")
    M.train_mlp(df, epochs=2, batches_per_epoch=2, ckpt_dir=root, ckpt_every=1)
    _p, h2 = M.train_mlp(df, epochs=3, batches_per_epoch=2, ckpt_dir=root, ckpt_every=1)
    assert [h["epoch"] for h in h2] == [3]


def test_registered_training_runs_15_epochs_on_all_rows(spark):
    from eventide.plans import QUERIES

    from conftest import SF_SMALL
    n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    hist = sorted(QUERIES["train_mlp"](spark, SF_SMALL).collect(), key=lambda r: r.epoch)
    assert [(h.epoch, h.rows) for h in hist] == [(e, n) for e in range(1, 16)]
    assert hist[-1].train_loss < hist[0].train_loss
    assert [h.epoch for h in sorted(QUERIES["checkpoint_resume"](spark, SF_SMALL).collect(), key=lambda r: r.epoch)] == list(range(9, 16))


def test_train_linear(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(300, 3))
    y = (x[:, 0] > 0.5).astype(int)
    df = spark.createDataFrame([([float(v) for v in row], int(t)) for row, t in zip(x, y)],
                               "scaled array<double>, label int")
    w, b = M.train_linear(df)
    s = M.score_linear(df, w, b)
    assert M.roc_auc(s.withColumn("y", F.col("label")), "fraud_probability", "y").first()["auc"] > 0.95


def test_synth_transactions(spark):
    t = M.synth_transactions(spark, 2000, seed=1)
    r = t.agg(F.count("*").alias("n"), F.min(F.size("features")).alias("d"), F.avg("_simulated_label").alias("f"),
              F.countDistinct("merchant_category").alias("c")).first()
    assert r.n == 2000 and r.d == 28 and 0.005 < r.f < 0.04 and r.c == 6
