"""Records, model versions, the training split and resumed training."""

import datetime as dt
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from eventide.operators import checkpoint as C
from eventide.operators import ml as M
from eventide.plans import serving as S
from eventide.sources import files as FS
from eventide.streaming import runtime as RT


def test_records_that_are_no_transactions_are_set_aside(spark):
    good = '{"transaction_id": "t", "account_id": "a", "timestamp": "2024-01-02T03:04:05.678901Z", "amount": 2.5, "features": [1, null], "more": {"x": 1}}'
    bad = ["", None, "not json", '{"transaction_id": "t"', "[]", "7", "{}", good.replace("2.5", '"many"'), good.replace('"a"', "null")]
    df = spark.createDataFrame([("k", good)] + [("k", b) for b in bad], "key string, value string")
    got = FS.json_records(df).collect()
    (ok,) = [r for r in got if r.corrupt is None]
    assert (ok.key, ok.transaction_id, ok.amount, ok.features, ok.merchant_category) == ("k", "t", 2.5, [1.0, None], None)
    assert ok.timestamp.microsecond == 678901
    assert sorted(r.corrupt for r in got if r.corrupt is not None) == sorted(b or "" for b in bad)
    assert all(r.transaction_id is None and r.amount is None for r in got if r.corrupt is not None)


def model(version, since, seed):
    r = np.random.default_rng(seed)
    return FS.Model(version, since, r.normal(size=M.INPUT_DIM).tolist(), r.uniform(.5, 2, M.INPUT_DIM).tolist(), M.init_mlp(seed))


def plain_score(m, x):
    z = (np.array(x) - m.mean) / m.std
    for i in range(2):
        z = np.maximum([sum(z[j] * float(m.params[f"W{i}"][j, k]) for j in range(len(z))) + float(m.params[f"b{i}"][k])
                        for k in range(m.params[f"W{i}"].shape[1])], 0)
    return 1 / (1 + math.exp(-(sum(z[j] * float(m.params["W2"][j, 0]) for j in range(len(z))) + float(m.params["b2"][0]))))


def test_the_version_in_force_scores(spark, tmp_path):
    root = str(tmp_path / "m")
    a, b, c = model(1, dt.datetime(2024, 1, 1), 1), model(3, dt.datetime(2024, 2, 1), 2), model(2, dt.datetime(2024, 3, 1), 3)
    for m in (c, a, model(3, dt.datetime(2020, 1, 1), 9), b):  # a version saved again is replaced
        FS.save_model(spark, root, m)
    got = FS.load_models(spark, root)
    assert [m.version for m in got] == [1, 3, 2]
    assert all(np.array_equal(x.params[k], y.params[k]) and x.mean == y.mean and x.std == y.std for x, y in zip(got, (a, b, c)) for k in x.params)
    x = np.random.default_rng(5).normal(size=M.INPUT_DIM).tolist()
    rows = [(0, dt.datetime(2023, 12, 31, 23, 59, 59, 999999), x), (1, dt.datetime(2024, 1, 1), x), (2, dt.datetime(2024, 2, 1), x),
            (3, dt.datetime(2024, 1, 31, 23, 59, 59, 999999), x), (4, dt.datetime(2030, 1, 1), x), (5, None, x), (6, dt.datetime(2024, 1, 1), x[:5]),
            (7, dt.datetime(2024, 1, 1), None), (8, dt.datetime(2024, 1, 1), [*x[:-1], None])]
    df = spark.createDataFrame(rows, "i int, ts timestamp, features array<double>")
    by = {r.i: r for r in M.score_versions(df, got, "ts").collect()}
    for i, m in ((1, a), (2, b), (3, a), (4, c)):
        p = plain_score(m, x)
        assert by[i].model_version == m.version and abs(by[i].fraud_probability - p) < 6e-7 and by[i].is_fraud == (p > .5)
    assert all((by[i].model_version, by[i].fraud_probability, by[i].is_fraud) == (None, None, None) for i in (0, 5, 6, 7, 8))


def test_models_are_checked(spark, tmp_path, monkeypatch):
    FS.save_model(spark, str(tmp_path / "m"), model(1, dt.datetime(2024, 1, 1), 1))
    monkeypatch.setattr(FS, "MAX_MODEL_BYTES", 1000)
    with pytest.raises(ValueError, match="retire"):
        FS.load_models(spark, str(tmp_path / "m"))
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no model"):
        FS.load_models(spark, str(tmp_path / "none"))


def test_a_trained_network_serves_a_stream(spark):
    """Train and save in one job; the stream that loads it gives what the batch job gives."""
    root = RT.scratch(spark, "test-models")
    test, history = S.trained_version(spark, SF_SMALL, root, epochs=2)
    assert [h["epoch"] for h in history] == [1, 2]
    models = FS.load_models(spark, f"{root}/models")
    train = M.split_train_test(S.embedded(spark, SF_SMALL).select("vec_id", "features"), "vec_id", 0.2, 42).filter(~F.col("is_test"))
    x = np.array([r.features for r in train.collect()])
    assert np.allclose(models[0].mean, x.mean(0)) and np.allclose(models[0].std, np.where(x.std(0) < 1e-8, 1, x.std(0)))
    assert not {r.vec_id for r in test.collect()} & {r.vec_id for r in train.collect()}
    good = S.record_stream(spark, SF_SMALL, "test-serve").filter("corrupt IS NULL")
    stream = RT.run_append(S.scored(good, models), "test-serve")
    batch = S.scored(S.transactions(spark, SF_SMALL).filter("merchant_category <> 'error'"), models)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))
    assert stream.filter("fraud_probability IS NOT NULL").count() > 100


@pytest.mark.parametrize("ids,frac", [(list(range(1000)), 0.2), ([7] * 300 + list(range(50)), 0.5), ([None, 1, 1, None, 2], 0.4), ([5], 0.9), ([], 0.2),
                                      (list(range(40)), 0.0), (list(range(40)), 1.0)])
def test_split_is_the_smallest_hashes(spark, ids, frac):
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id bigint, n int").repartition(3)
    got = M.split_train_test(df, "id", frac, 42).collect()
    key = lambda i: (int(hashlib.md5(f"{'' if i is None else i}|42".encode()).hexdigest()[:15], 16), i is not None, i or 0)
    want = sorted(ids, key=key)[:int(len(ids) * frac)]
    assert sorted((r.id for r in got if r.is_test), key=key) == want and len(got) == len(ids)


def test_split_sorts_nothing(spark):
    plan = M.split_train_test(spark.range(1000), "id")._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Sort " not in plan


def rows_to_train(spark, n=400):
    r = np.random.default_rng(1)
    x = r.normal(size=(n, M.INPUT_DIM))
    return spark.createDataFrame([([float(v) for v in row], int(row[0] + row[1] > 1)) for row in x], "scaled array<double>, label int").repartition(4).cache()


def test_a_resumed_run_is_an_unbroken_one(spark, tmp_path):
    df = rows_to_train(spark)
    whole, history = M.train_mlp(df, epochs=4, batch_rows=32, workers=2)
    root = str(tmp_path / "c")
    M.train_mlp(df, epochs=2, batch_rows=32, workers=2, ckpt_dir=root, ckpt_every=1)
    resumed, rest = M.train_mlp(df, epochs=4, batch_rows=32, workers=2, ckpt_dir=root, ckpt_every=1)
    assert all(np.array_equal(whole[k], resumed[k]) for k in whole)
    assert [h["epoch"] for h in rest] == [3, 4]
    assert np.allclose([h["train_loss"] for h in rest], [h["train_loss"] for h in history[2:]])


def test_a_missing_epoch_starts_over(spark, tmp_path):
    root = tmp_path / "c"
    assert C.load_latest(spark, str(root)) is None
    state = {"params": M.init_mlp(1), "m": M.init_mlp(2), "v": M.init_mlp(3), "t": 5}
    C.save(spark, str(root), 3, state)
    assert C.load_latest(spark, str(root))["epoch"] == 3
    (root / "epoch=3").rename(tmp_path / "gone")
    assert C.load_latest(spark, str(root)) is None
    (root / "epoch=3").mkdir()
    assert C.load_latest(spark, str(root)) is None
