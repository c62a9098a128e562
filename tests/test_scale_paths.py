"""The hot-key split path must give the same answers as the plain path,
and no registered query may plan a cartesian product."""

import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from eventide.operators import sequences
from eventide.operators.scan import PIECE, global_prefix_sum, global_rank, running, split
from eventide.session import ensure_checkpoint_dir, scratch_space, staged

SPLIT_CHECKED = ["max_gain", "fill_depth", "max_span_pair", "pair_sum", "position_of", "misplaced_count",
                 "rollover_point", "longest_distinct_run", "min_covering_span", "reverse_order", "merge_intervals",
                 "max_concurrency", "longest_increasing", "max_rectangle", "compact_log", "batch_adds", "remove_n", "remove_n_tail", "kv_snapshot",
                 "allocate_slots", "max_nonadjacent_sum", "nesting_valid", "next_greater"]


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("name", SPLIT_CHECKED)
def test_hot_key_split_matches(spark, name):
    q = E.queries()[name]
    got = []
    for pieces in ("1", "9"):  # one piece is a plain window; with 9 some keys reach over several
        spark.conf.set("eventide.scan.pieces", pieces)
        try:
            got.append(_rows(q(spark, SF_SMALL)))
        finally:
            spark.conf.unset("eventide.scan.pieces")
    assert got[0] == got[1]


def test_no_cartesian_plans(spark):
    skip = {"word_ladder", "train_mlp", "checkpoint_resume", "train_linear", "labeled_csv_source"}
    for name, q in E.queries().items():
        if name in skip or name.startswith(("stream_", "op")) or name == "pipeline":
            continue
        plan = q(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture
def pieces(spark):
    spark.conf.set("eventide.scan.pieces", "23")
    yield
    spark.conf.unset("eventide.scan.pieces")


def test_global_rank_heavy_value(spark, pieces):
    # one key value holds 40 % of the rows; ties broken by src, pos
    rows = [(7 if i % 5 < 2 else i, i % 3, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "key bigint, src int, pos bigint")
    want = {r[2]: n for n, r in enumerate(sorted(rows))}
    got = {r.pos: r.rank for r in global_rank(df, ["key", "src", "pos"], "rank").collect()}
    assert got == want
    ps = global_prefix_sum(df.withColumn("one", F.lit(1)), ["key", "src", "pos"], "one", "before")
    assert {r.pos: r.before for r in ps.collect()} == want


def test_global_rank_of_strings_with_a_common_start(spark, pieces):
    words = ["b", "ab", "a", "", "abc", "B", "éa"] * 40 + [f"https://site{i % 50:02d}.example.com/{i % 7}" for i in range(4000)]
    df = spark.createDataFrame(list(zip(words, range(len(words)))), "w string, i int")
    order = sorted(zip(words, range(len(words))), key=lambda t: (t[0].encode(), t[1]))
    got = {r.i: r.rank for r in global_rank(df, ["w", "i"], "rank").collect()}
    assert got == {i: n for n, (_, i) in enumerate(order)}


def test_global_rank_of_equal_rows_is_gapless_and_spread(spark, pieces):
    df = spark.createDataFrame([(1,)] * 5000, "x int")
    assert sorted(r.rank for r in global_rank(df, "x", "rank").collect()) == list(range(5000))


SPECS = {"c": ("count", "c"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "p": ("last", "v")}


def plain(df, keys, order, reverse, exclusive, by=()):
    w = Window.partitionBy(*keys, *by).orderBy(*order)
    f = w.rowsBetween(int(exclusive), Window.unboundedFollowing) if reverse else w.rowsBetween(Window.unboundedPreceding, -int(exclusive))
    for n, (how, c) in SPECS.items():
        e = F.count(F.lit(1)).over(f) if how == "count" else (F.lead(c) if reverse else F.lag(c)).over(w) if how == "last" else getattr(F, how)(c).over(f)
        df = df.withColumn(n, e)
    return df


@pytest.mark.parametrize("reverse,exclusive,by", [(False, False, ()), (False, True, ("g",)), (True, True, ()), (True, False, ("g",))])
def test_running_is_a_plain_window(spark, pieces, reverse, exclusive, by):
    """Hot keys, null keys and groups, and a string order whose first column ties over a thousand rows."""
    rows = [("hot" if i % 3 else None if i % 5 == 0 else f"k{i % 9}", None if i % 4 == 0 else i % 4, "https://tie" if i % 2 else f"https://x{i % 40}",
             i, None if i % 11 == 0 else (i * 37) % 101) for i in range(2500)]
    df = spark.createDataFrame(rows, "k string, g int, url string, i int, v int")
    got = running(df, "k", ["url", "i"], SPECS, by=by, reverse=reverse, exclusive=exclusive)
    want = plain(df, ["k"], ["url", "i"], reverse, exclusive, by)
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)


def test_running_splits_ties(spark, pieces):
    df = spark.createDataFrame([("a", 0, i) for i in range(1000)], "k string, t int, i int")
    s = split(df, "k", ["t", "i"])
    assert s.df.groupBy(PIECE).count().count() > 10
    assert running(df, "k", ["t", "i"], {"c": ("count", "c")}).filter("c <> i + 1").count() == 0


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, t int, v int")
    assert running(df, "k", "t", {"c": ("sum", "v")}).count() == 0
    assert global_rank(df, "t").count() == 0 and global_prefix_sum(df, "t", "v", "s").count() == 0


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_next_greater_and_rectangle_by_blocks(spark, monkeypatch, fan):
    monkeypatch.setattr(sequences, "FAN", fan)
    r = random.Random(fan)
    data = {k: [r.randint(0, 9) for _ in range(n)] for k, n in (("a", 1), ("b", 40), ("c", 77), ("d", 5))} | {"up": list(range(30)), "down": list(range(30, 0, -1))}
    df = spark.createDataFrame([(k, i, v) for k, vs in data.items() for i, v in enumerate(vs)], "k string, i int, v int")
    got = {(x.k, x.pos): x.steps for x in sequences.next_greater(df, "k", "i", "v").collect()}
    want = {(k, i): next((j - i for j in range(i, len(vs)) if vs[j] > vs[i]), 0) for k, vs in data.items() for i in range(len(vs))}
    assert got == want
    best = {k: max(min(vs[i:j]) * (j - i) for i in range(len(vs)) for j in range(i + 1, len(vs) + 1)) for k, vs in data.items()}
    assert {x.k: x.max_rectangle for x in sequences.max_rectangle(df, "k", "i", "v").collect()} == best


def test_rectangle_of_doubles(spark):
    df = spark.createDataFrame([("a", i, 0.7) for i in range(3)], "k string, i int, v double")
    assert abs(sequences.max_rectangle(df, "k", "i", "v").first().max_rectangle - 2.1) < 1e-9


def test_covering_span_of_three(spark, pieces):
    items = "xaabxbacabaacca"
    df = spark.createDataFrame([("k", i, c) for i, c in enumerate(items * 3)], "k string, i int, c string")
    got = sequences.min_covering_span(df, "k", "i", "c", {"a": 3, "b": 1, "c": 2}).first()
    text = items * 3
    best = min((j - i, i) for i in range(len(text)) for j in range(i + 1, len(text) + 1)
               if text[i:j].count("a") >= 3 and "b" in text[i:j] and text[i:j].count("c") >= 2)
    assert (got.span_len, got.span_start) == best


def _written(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    streams = os.listdir(f"{root}/stream") if os.path.isdir(f"{root}/stream") else []
    return {p for p in os.listdir(root) if p.startswith("staged-")} | set(streams)


@pytest.mark.parametrize("name", ["pair_sum", "sorted_merge", "longest_increasing", "shortest_path_len", "stream_velocity_tumbling"])
def test_scratch_space_leaves_nothing(spark, name):
    before = _written(spark)
    with scratch_space(spark):
        df = E.queries()[name](spark, SF_SMALL)
        with scratch_space(spark):  # its end leaves alone what the space around it holds
            inner = staged(spark.range(3))
            assert inner.count() == 3
        assert _written(spark) > before
        assert _rows(df) == _rows(E.queries()[name](spark, SF_SMALL))
    assert _written(spark) == before


def test_scratch_space_after_a_failure(spark):
    before = _written(spark)
    with pytest.raises(ZeroDivisionError), scratch_space(spark):
        staged(spark.range(3))
        1 / 0
    assert _written(spark) == before
