"""min_removals as paths in a forest, bracketed trees, replayed dashboard batches."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import by_key
from eventide.operators import intervals as I
from eventide.operators import sets as ST
from eventide.operators import trees as TR
from eventide.operators.dashboard import dashboard_metrics
from eventide.streaming import runtime as RT


def greedy(rows):
    kept, last = 0, None
    for s, e in sorted(((s, max(s, e)) for s, e in rows), key=lambda r: (r[1], r[0])):
        if last is None or s >= last:
            kept, last = kept + 1, e
    return len(rows) - kept


@pytest.mark.parametrize("pieces", ["1", "9"])
def test_min_removals_is_the_greedy_rule(spark, pieces):
    r = random.Random(4)
    groups = {f"k{i}": [(a, a + r.randint(-1 if i % 5 == 0 else 0, 12)) for a in (r.randint(0, 60) for _ in range(r.randint(1, 40)))] for i in range(30)}
    groups["hot"] = [(a, a + r.randint(0, 9)) for a in (r.randint(0, 4000) for _ in range(3000))]
    groups["same"] = [(5, 5)] * 4 + [(1, 5), (5, 9), (5, 5)]
    groups["chain"] = [(i, i + 1) for i in range(700)]
    df = spark.createDataFrame([(k, s, e) for k, v in groups.items() for s, e in v], "k string, s int, e int")
    spark.conf.set("eventide.scan.pieces", pieces)
    try:
        assert by_key(I.min_removals(df, "k", "s", "e"), "min_removals") == {k: greedy(v) for k, v in groups.items()}
    finally:
        spark.conf.unset("eventide.scan.pieces")


def test_min_removals_edges(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 2), (None, 1, 3), (None, 2, 4)], "k string, s int, e int")
    assert by_key(I.min_removals(df, "k", "s", "e"), "min_removals") == {"a": 0, None: 1}
    assert I.min_removals(df.limit(0), "k", "s", "e").count() == 0


def test_path_sums(spark):
    rows = [(i, i + 1 if i < 999 else None, 1) for i in range(1000)] + [(2000, 5, 10)]
    got = {r.v: r.w for r in I.path_sums(spark.createDataFrame(rows, "v bigint, p bigint, w bigint"), "v", "p", "w").collect()}
    assert got == {**{i: 1000 - i for i in range(1000)}, 2000: 10 + 995}


@pytest.mark.parametrize("text", ["1,2,3,null,null,4,5", "[1,2,3,null,null,4,5]", " [1, 2,3 , null,null,4,5] "])
def test_bracketed_trees(spark, text):
    enc = spark.createDataFrame([(1, text), (2, "[]"), (3, ""), (4, "[null]"), (5, "[7]")], "tree_id bigint, data string")
    dec = TR.decode_trees(enc)
    got = sorted((r.tree_id, r.node_id, r.parent_id, r.side, r.val) for r in dec.collect())
    assert got == [(1, 0, None, None, "1"), (1, 1, 0, 0, "2"), (1, 2, 0, 1, "3"), (1, 3, 2, 0, "4"), (1, 4, 2, 1, "5"), (5, 0, None, None, "7")]
    assert {r.tree_id: r.data for r in TR.encode_trees(dec, brackets=True).collect()} == {1: "[1,2,3,null,null,4,5]", 5: "[7]"}


def test_merged_ranks_are_the_merged_order(spark):
    a = spark.createDataFrame([(k, i) for i, k in enumerate([1, 3, 3, 5])], "k int, i int")
    b = spark.createDataFrame([(k, i) for i, k in enumerate([0, 3, 9])], "k int, i int")
    got = sorted((r.merged_pos, r.k, r.src_idx, r.i) for r in ST.merged_ranks([a, None, b], "k", "i").collect())
    assert [g[1:] for g in got] == [(r.k, r.src_idx, r.i) for r in ST.sorted_merge([a, None, b], "k", "i").collect()]
    assert [g[0] for g in got] == list(range(7))


def test_a_replayed_batch_changes_nothing(spark):
    out = RT.scratch(spark, "replay")
    r = random.Random(1)
    rows = [(i, r.random() if i % 7 else None, r.random() > .5) for i in range(900)]
    batches = [spark.createDataFrame(rows[a:a + 150], "event_id int, fraud_probability double, is_fraud boolean") for a in range(0, 900, 150)]
    sink = RT.newest_sink(out, ["event_id"], 200, lambda d: dashboard_metrics(d, ["event_id"], 200))
    for i, b in enumerate(batches):
        for _ in range(1 + i % 3):  # a batch that failed after its writes runs again
            sink(b, i)
        seen = spark.createDataFrame(rows[:150 * (i + 1)], batches[0].schema)
        assert RT.latest_metrics(spark, out).collect() == dashboard_metrics(seen, ["event_id"], 200).collect()
    assert spark.read.parquet(f"{out}/newest=5").count() == 200


def forest(r, n, trees):
    """Random forest rows (tree, node, parent, ord) with shuffled ids, some orphans and a cycle."""
    rows, of = [], {}
    ids = r.sample(range(10 * n), n)
    for i, v in enumerate(ids):
        t = f"t{r.randint(1, trees)}"
        held = of.setdefault(t, [])
        rows.append((t, v, r.choice(held[-4:]) if held and r.random() < .98 else None, r.randint(0, 3)))
        held.append(v)
    top = 10 * n
    return rows + [("t1", top, top + 9, 0), ("t1", top + 1, top, 0), ("t1", top + 2, top + 3, 0), ("t1", top + 3, top + 2, 0), ("t9", top + 4, top + 4, 0)]


def plain_levels(rows):
    kids = {}
    for t, v, p, o in rows:
        kids.setdefault((t, p), []).append((o, v))
    out = []
    for t in {r[0] for r in rows}:
        level, depth = [v for _, v in sorted(kids.get((t, None), []))], 0
        while level:
            out += [(t, depth, i, v) for i, v in enumerate(level)]
            level, depth = [c for v in level for _, c in sorted(kids.get((t, v), []))], depth + 1
    return sorted(out)


@pytest.mark.parametrize("pieces", ["1", "9"])
def test_level_order_of_deep_forests(spark, pieces):
    rows = forest(random.Random(3), 600, 4)
    want = plain_levels(rows)
    assert max(x[1] for x in want) > 40
    spark.conf.set("eventide.scan.pieces", pieces)
    try:
        df = spark.createDataFrame(rows, "tree_id string, node_id bigint, parent_id bigint, ord int").repartition(4)
        assert sorted((x.tree_id, x.depth, x.pos, x.node_id) for x in TR.level_order(df).collect()) == want
        assert TR.level_order(df.limit(0)).count() == 0
    finally:
        spark.conf.unset("eventide.scan.pieces")


def test_a_long_chain_takes_few_rounds(spark):
    n = 3_000
    chain = spark.range(n).select(F.lit(1).alias("tree_id"), (F.col("id") * 7919 % n).alias("node_id"),
                                  F.when(F.col("id") > 0, (F.col("id") - 1) * 7919 % n).alias("parent_id"), F.lit(0).alias("ord"),
                                  F.lit(1).alias("side"), F.col("id").alias("val"))
    got = TR.level_order(chain)
    assert got.filter((F.col("pos") != 0) | (F.col("depth") * 7919 % n != F.col("node_id"))).count() == 0 and got.count() == n
    data = TR.encode_trees(chain).first().data.split(",")
    assert [x for x in data if x != "null"] == [str(i) for i in range(n)] and len(data) == 2 * n - 1
