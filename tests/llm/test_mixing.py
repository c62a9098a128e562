import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventide.llm import mixing as M

from .helpers import none, odd, odd_rows, prose


def size_of(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight, those above the cap cut and the excess reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        x = left / sum(w[s] for s in free)
        over = {s for s in free if x * w[s] > cap * sizes[s]}
        if not over:
            return out | {s: x * w[s] for s in free}
        out |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return out


def check(rows, got):
    """rows: (doc_id, source, text)."""
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += size_of(t)
    want = plain_targets(sizes)
    assert sorted(((r[0], r[1], r[2], round(r[3], 6)) for r in got), key=str) == \
        sorted(((i, size_of(t), sizes[s], round(want[s], 6)) for i, s, t in rows), key=str)
    assert all(0 <= r[4] <= 3 * r[1] for r in got)
    return want


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1000, 65537])
def test_permutation(size):
    for key in (0, 1, 2**63 + 5):
        got = M.permuted(np.arange(size), np.full(size, size), np.full(size, key, np.uint64))
        assert sorted(got.tolist()) == list(range(size))
    if size >= 1000:
        assert (got != np.arange(size)).mean() > 0.9


@pytest.mark.parametrize("size,target", [(1, 3.0), (10, 7.0), (100, 100.0), (1000, 2999.5), (1000, 3000.0), (1003, 1500.2), (5, 0.2)])
@pytest.mark.parametrize("block", [1, 7, 64])
def test_quota_is_met_to_the_word(size, target, block):
    for key in range(20):
        n, epochs, last, over = M.quota(size, target, key, block, 3)
        want = min(int(target + 0.5), 3 * size)
        at = M.permuted(np.arange(n), np.full(n, n), M._epoch_key(np.full(n, key, np.uint64), epochs))
        length = np.minimum(block, size - np.arange(n) * block)
        assert epochs * size + length[at < last].sum() - over == want
        assert not last or over < length[at == last - 1][0]


def test_split_is_exact_and_random_like_a_shuffle():
    counts, sizes = [50, 0, 30, 20], [25, 25, 30, 15, 5]
    seen = np.array([M.split(counts, sizes, (s,)) for s in range(600)])
    assert (seen >= 0).all() and (seen.sum(axis=1) == counts).all() and (seen.sum(axis=2) == sizes).all()
    mean = np.outer(sizes, counts) / 100
    var = np.outer(np.array(sizes) * (1 - np.array(sizes) / 100), np.array(counts) / 100 * (1 - np.array(counts) / 100)) * 100 / 99
    assert (np.abs(seen.mean(axis=0) - mean) <= 5 * np.sqrt(var / 600) + 1e-9).all()
    assert np.allclose(seen.var(axis=0), var, rtol=0.35, atol=0.05)


def test_large_populations_stay_exact():
    counts, sizes = [3 * 10**9, 7 * 10**9, 5], [4 * 10**9, 6 * 10**9, 5]
    got = np.array(M.split(counts, sizes, (1,)))
    assert (got >= 0).all() and got.sum(axis=0).tolist() == counts and got.sum(axis=1).tolist() == sizes


@pytest.mark.parametrize("block,chunk", [(1, 4096), (16, 4096), (16, 2)])
def test_mix(spark, block, chunk):
    texts = prose(4, 500, most=40)
    rows = [(i, ("web", "books", "code", None, "tiny")[min(4, i % 9 if i % 9 < 4 else 0 if i % 50 else 4)], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(6)
    opts = {"block": block, "chunk": chunk, "shards": 7}
    mixed = M.mix_sources(df, **opts)
    pieces = [(r.doc_id, *p) for r in mixed.collect() for p in r.pieces]
    got = [tuple(r) for r in M.report(df.repartition(3), **opts).collect()]
    want = check(rows, got)
    of = {i: s for i, s, _ in rows}
    taken = Counter()
    for r in got:
        taken[of[r[0]]] += r[4]
    assert {s: taken[s] for s in want} == {s: int(want[s] + 0.5) for s in want}
    # the pieces are those of the report, and no word is taken twice in an epoch
    per = Counter()
    seen = set()
    for i, _, _, e, a, z in pieces:
        assert 0 <= a < z <= size_of(texts[i])
        per[i] += z - a
        new = {(i, e, w) for w in range(a, z)}
        assert not new & seen
        seen |= new
    assert per == Counter({r[0]: r[4] for r in got if r[4]})
    # shards hold equal numbers of blocks (a block's pieces share their place) and all sources
    held = {s: {(of[p[0]], p[2]) for p in pieces if p[1] == s} for s in range(7)}
    assert sum(map(len, held.values())) == len({x for h in held.values() for x in h})
    assert max(map(len, held.values())) - min(map(len, held.values())) <= 1
    assert all(len({s for s, _ in h}) >= 4 for h in held.values())
    assert M.shuffled(mixed).count() == len(pieces)


def test_many_sources(spark):
    rows = [(i, f"s{i % 400}" if i % 3 else "hot", "w " * (i % 13)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = [tuple(r) for r in M.report(df, chunk=64).collect()]
    want = check(rows, got)
    of, taken = {i: s for i, s, _ in rows}, Counter()
    for r in got:
        taken[of[r[0]]] += r[4]
    assert all(taken[s] == int(x + 0.5) for s, x in want.items())


def test_odd_rows_and_empty_table(spark):
    got = [tuple(r) for r in M.report(odd(spark)).collect()]
    check([(r[0], r[3], r[1]) for r in odd_rows()], got)
    assert M.report(none(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, None), (2, "a", " ")], "doc_id bigint, source string, text string")
    assert sorted(tuple(r) for r in M.report(nothing).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
