import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import periods as P

from .helpers import none, odd, odd_rows, prose


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def plain(w, least=6, times=4):
    """Every run by its definition: per period the maximal stretches, kept if no smaller period fits."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q) and j > i and smallest_period(w[i:i + length]) == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbered(lists):
    at, out, first = {}, [], [0]
    for d, ws in enumerate(lists):
        out += [at.setdefault((d, w), len(at)) for w in ws]
        first.append(len(out))
    return np.array(out, np.int64), np.array(first)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from("ab"), max_size=40),
                          st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 8))
                            .map(lambda x: (x[0] * x[1])[:max(0, len(x[0]) * x[1] - x[2])])), max_size=6),
       st.sampled_from([(6, 4), (6, 3), (2, 3), (9, 5)]))
def test_runs_by_definition(lists, rule):
    got = P.runs(*numbered(lists), *rule)
    assert got == [(d, *r) for d, ws in enumerate(lists) for r in plain(ws, *rule)]


def test_runs_with_random_surroundings():
    r = random.Random(3)
    for _ in range(200):
        ws = []
        for _ in range(r.randint(1, 5)):
            ws += [r.choice("abcdefgh") for _ in range(r.randint(0, 30))]
            root = [r.choice("abc") for _ in range(r.randint(1, 20))]
            ws += (root * 9)[:r.randint(1, 9 * len(root))]
        assert P.runs(*numbered([ws])) == [(0, *x) for x in plain(ws)]


def test_long_texts_are_not_quadratic():
    for ws in (np.zeros(300_000, np.int64), np.arange(300_000) % 70_001, np.arange(300_000)):
        got = P.runs(ws, np.array([0, len(ws)]))
        assert len(got) == (len(set(ws.tolist())) <= 75_000)


def test_two_periods_are_refused():
    with pytest.raises(ValueError):
        P.runs(np.zeros(4, np.int64), np.array([0, 4]), 2, 2)


def expected(i, text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(ws)
    h = None if i is None else zlib.crc32(str(i).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[j] if j < a else ws[a + (j - a) % p] for j in range(n)]
    runs = plain(ws)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    drop = {j for s, length, q in runs for j in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for j, w in enumerate(ws) if j not in drop)))


def check(df, rows):
    got = P.report(df)
    assert [t for _, t in got.dtypes] == [df.schema["doc_id"].dataType.simpleString()] + ["bigint"] * 5 + ["string"] * 2
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((expected(i, t) for i, t in rows), key=str)


def test_report_against_definition(spark):
    rows = list(enumerate(prose(8, 200, words=12)))
    rows += [(1000 + i, ("x y  z\t" * i) + "end " + "q " * (i % 9)) for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), rows)
    assert sum(expected(*r)[1] > 0 for r in rows) > 60


def test_collapsed_text_and_carried_columns(spark):
    df = spark.createDataFrame([("k", "a b a b a b a b c c c c c c d", 7)], "id string, text string, x int")
    r = P.find(df, ["x", "id"]).first()
    assert (r.x, r.id, r.n_words, r.collapsed) == (7, "k", 15, "a b c d")
    assert [tuple(x) for x in r.runs] == [(0, 8, 2), (8, 6, 1)]


def test_odd_rows_and_empty_table(spark):
    check(odd(spark), [(i, t) for i, t, *_ in odd_rows()])
    assert P.report(none(spark)).count() == 0
