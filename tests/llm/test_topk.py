import numpy as np
import pytest

from eventide.llm import topk as K

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, id string, dims int"


def brute(rows, ids, k=5):
    good = []
    for i, v in {(r[0], None if r[1] is None else tuple(r[1])) for r in rows}:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v):
            good.append((i, [int(np.floor(256 * float(np.float32(c)))) for c in v]))
    out = []
    for q, x in good:
        if q in ids:
            s = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s[:k])]
    return sorted(out)


def rows(n=400, d=8, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(0, .3, (n, d)).astype(np.float32)
    x[50:80] = x[50]  # equal vectors: ties
    out = [(i, v.tolist(), 0, "a", "b", 1) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    return out + [(1000, None, 0, "a", "b", 1), (1050, [], 0, "a", "b", 1), (1100, [0.1, None] * 4, 0, "a", "b", 1),
                  (1150, [nan] * 8, 0, "a", "b", 1), (1200, [inf] * 8, 0, "a", "b", 1), (1250, [.1, .2], 0, "a", "b", 1),
                  (1251, [.3, .2], 0, "a", "b", 1), (None, [.1] * 8, 0, "a", "b", 1), (100, x[100].tolist(), 0, "a", "b", 1),
                  (1300, [1.0, 2.0, 3.0], 0, "a", "b", 1), (-50, [.5] * 8, 0, "a", "b", 1)]


@pytest.mark.parametrize("shard,block", [(64, 3), (8192, 16384)])
def test_top_k_is_brute_force(spark, shard, block):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = K.top_k(df, df.filter("vec_id % 50 = 0"), shard_rows=shard, block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(data, {r[0] for r in data if r[0] is not None and r[0] % 50 == 0})


def test_empty_tables(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert K.top_k(e, e).count() == 0
    one = spark.createDataFrame(rows()[:1], SCHEMA)
    assert K.top_k(one, one).count() == 0


def test_bounds_hold_and_prune():
    r = np.random.default_rng(2)
    centres = r.integers(-200, 200, (12, 6))
    x = centres[r.integers(0, 12, 5000)] + r.integers(-5, 6, (5000, 6))
    t = K.Tree(np.arange(5000), x)
    q = r.integers(-200, 200, (20, 6))
    for node in range(len(t.lo)):
        inside = q @ t.x[t.lo[node]:t.hi[node]].T
        bound = q @ t.centre[node] + np.sqrt((q ** 2).sum(1)) * t.radius[node]
        assert (inside.max(axis=1) <= bound + 1e-6).all()
    s = K.Search(np.arange(-20, 0), q, 5, np.full(20, -np.inf))
    seen = []
    leaf = s._leaf
    s._leaf = lambda t, node, who, exact: (seen.append(len(who) * (t.hi[node] - t.lo[node])), leaf(t, node, who, exact))
    s.visit(K.Tree.unpack(t.pack()))
    assert sum(seen) < 0.5 * 20 * 5000
    who, ids, score = s.results()
    want = np.sort(-(q @ x.T), axis=1)[:, :5]
    assert (score.reshape(20, 5) == -want[np.argsort(np.arange(-20, 0))]).all()


def test_large_components_stay_exact(spark):
    data = [(0, [3.0e9, 1.0], 0, "", "", 1), (1, [1.0, 1.0e9], 0, "", "", 1), (2, [1.0, 1.00001e9], 0, "", "", 1)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int, x string, id string, dims int")
    got = K.top_k(df, df.filter("vec_id = 0"), scale=1).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 3_000_000_000 + 1_000_010_000), (1, 4_000_000_000)]
