"""What the findings of the fourth round asked for, on rows of their own."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from eventide.operators import ml as M
from eventide.session import freed_shuffles
from eventide.sources import files as FS
from eventide.streaming import runtime as RT


def labelled(spark, n=400):
    """``n`` rows of scaled vectors; every seventh has no label."""
    r = np.random.default_rng(3)
    rows = [(i, [float(v) for v in x], None if i % 7 == 0 else int(x[0] > 0.5)) for i, x in enumerate(r.normal(size=(n, M.INPUT_DIM)))]
    return spark.createDataFrame(rows, "i int, scaled array<double>, label int").repartition(3, "i").cache()


def test_rows_without_a_label_are_left_out_one_by_one(spark):
    df = labelled(spark)
    got, history = M.train_mlp(df, epochs=3, batch_rows=32, workers=2)
    want, alone = M.train_mlp(df.filter("label IS NOT NULL"), epochs=3, batch_rows=32, workers=2)
    assert all(np.array_equal(got[k], want[k]) and np.abs(got[k]).max() < 1 for k in want)
    assert [h["rows"] for h in history] == [400 - 58] * 3
    assert np.allclose([h["train_loss"] for h in history], [h["train_loss"] for h in alone]) and history[0]["train_loss"] > 0.1


@pytest.mark.parametrize("bad", ["CAST('NaN' AS DOUBLE)", "CAST(NULL AS DOUBLE)", "1e30D"])
def test_a_loss_that_is_no_number_is_an_error(spark, bad):
    df = labelled(spark).withColumn("scaled", F.expr(f"IF(i = 5, transform(scaled, (x, j) -> IF(j = 2, {bad}, x)), scaled)"))
    with pytest.raises(ArithmeticError, match="epoch 1"):
        M.train_mlp(df, epochs=2, batch_rows=32, workers=2)


def test_no_labels_train_nothing(spark):
    with pytest.raises(ValueError, match="no row"):
        M.train_mlp(labelled(spark).withColumn("label", F.lit(None).cast("int")), epochs=1, batch_rows=32, workers=2)


def tables(spark, root, events):
    """A folder of ``events`` (event_id, ts), every fifth an error, and 7 embeddings."""
    r = np.random.default_rng(1)
    spark.createDataFrame([(i, i % 3, t, "error" if i % 5 == 0 else "view", float(i)) for i, t in events],
                          "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double").write.parquet(f"{root}/events.parquet")
    spark.createDataFrame([(i, [float(x) for x in r.normal(size=64)], i % 2) for i in range(7)],
                          "vec_id bigint, embedding array<float>, label int").write.parquet(f"{root}/embeddings.parquet")
    return str(root)


def watched(monkeypatch):
    """The folders of the stream's input, and (slices, records) in them whenever a query starts."""
    roots, seen, scratch, sink = [], [], RT.scratch, FS.predictions_sink

    def place(spark, name):
        path = scratch(spark, name)
        if name == "ssm-in":
            roots.append(path.removeprefix("file:"))
        return path

    def started(df, *args, **options):
        seen.append((len(os.listdir(roots[0])), df.sparkSession.read.option("recursiveFileLookup", "true").parquet(roots[0]).count()))
        return sink(df, *args, **options)

    monkeypatch.setattr(RT, "scratch", place)
    monkeypatch.setattr(FS, "predictions_sink", started)
    return roots, seen


def test_one_slice_of_records_is_on_disk(spark, tmp_path, monkeypatch):
    # most events in one hour, 30 at one time: slices have equal rows all the same, and none is lost or comes twice
    t = dt.datetime(2024, 1, 14, 23, 30)
    times = [t + dt.timedelta(seconds=25 * i) for i in range(140)] + [t + dt.timedelta(seconds=3000)] * 30 + [t - dt.timedelta(days=20), t + dt.timedelta(days=30)]
    d = tables(spark, tmp_path, enumerate(times))
    monkeypatch.setattr(RT, "SLICE_ROWS", 15, raising=False)
    roots, seen = watched(monkeypatch)
    got = E.queries()["stream_score_model"](spark, d)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, E.queries()["score_model"](spark, d).collect()))
    assert got.count() == sum(i % 5 > 0 for i in range(172))
    assert len(seen) > 9 and all(slices == 1 for slices, _ in seen) and sum(n for _, n in seen) == 172 and max(n for _, n in seen) < 50
    assert os.listdir(roots[0]) == []


def test_events_without_a_time_are_in_no_slice(spark, tmp_path):
    d = tables(spark, tmp_path / "a", [(1, None), (2, dt.datetime(2024, 1, 20)), (3, None)])
    assert [r.transaction_id for r in E.queries()["stream_score_model"](spark, d).collect()] == ["2"]


def test_shuffles_are_freed(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    with pytest.raises(KeyError), freed_shuffles(spark):
        assert spark.conf.get(name) == "true" and spark.range(1000).groupBy(F.col("id") % 3).count().count() == 3
        raise KeyError
    assert spark.conf.get(name, None) == old
