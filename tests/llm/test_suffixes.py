import random
import re
from collections import defaultdict

import numpy as np
import pytest

from eventide.llm import suffixes as S

from .helpers import none, odd


def case():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(30)]
    rnd = lambda n: [r.choice(vocab) for _ in range(n)]
    passages = [rnd(r.randint(8, 40)) for _ in range(12)]
    docs = []
    for i in range(160):
        t = []
        for _ in range(r.randint(0, 6)):
            t += r.choice(passages) if r.random() < .5 else rnd(r.randint(1, 15))
        docs.append((i, " ".join(t)))
    return docs + [(200, None), (201, ""), (202, docs[5][1]), (203, "the " * 60), (204, "The, " * 45), (205, docs[5][1]),
                   (205, docs[5][1]), (206, "a b " * 40), (207, "only here " * 40), (207, "only here " * 40)]


def brute(docs, w):
    at, words = defaultdict(set), []
    for i, t in docs:
        words.append((i, re.findall("[0-9a-z]+", (t or "").lower())))
        for s in range(len(words[-1][1]) - w + 1):
            at[tuple(words[-1][1][s:s + w])].add(i)
    runs = defaultdict(set)
    for i, x in words:
        runs[i] |= {(s, s + w) for s in range(len(x) - w + 1) if len(at[tuple(x[s:s + w])]) > 1}
    out = {}
    for i, c in runs.items():
        m = []
        for a, b in sorted(c):
            if m and a <= m[-1][1]:
                m[-1][1] = max(b, m[-1][1])
            else:
                m.append([a, b])
        if m:
            out[i] = (len(m), sum(b - a for a, b in m), ",".join(f"{a}:{b}" for a, b in m))
    return out


@pytest.mark.parametrize("window,gram,bits", [(12, 7, 1 << 20), (12, 12, 1 << 20), (12, 1, 1 << 20), (20, 9, 1 << 15)])
def test_report_is_brute_force(spark, window, gram, bits):
    docs = case()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_spans, r.n_repeated, r.spans) for r in S.report(df, window=window, gram=gram, bits=bits).collect()}
    assert got == brute(docs, window)


def test_least_and_run_hashes():
    x = np.random.default_rng(1).integers(0, 99, 300).astype(np.uint64)
    for span in (1, 2, 3, 25, 31, 300):
        assert (S.least(x, span) == [x[i:i + span].min() for i in range(301 - span)]).all()
    h = S.run_hashes(np.tile(x[:40], 3), 10)
    assert (h[:40] == h[40:80]).all() and len(np.unique(h[:40])) == 40


def test_odd_and_empty_tables(spark):
    got = {r.doc_id: r.spans for r in S.report(odd(spark)).collect()}
    assert got == {6: "0:180", 7: "0:180"}
    assert S.report(none(spark)).count() == 0


def test_each_row_without_id_is_a_document(spark):
    r = random.Random(9)
    rnd = lambda n: " ".join(f"w{r.randrange(500)}" for _ in range(n))
    a, b, c = rnd(30), rnd(30), rnd(30)
    docs = [(1, f"{rnd(20)} {a} {rnd(20)}"), (None, f"{rnd(7)} {a}"), (None, f"{b} {rnd(9)} {c} {rnd(9)} {c}"), (None, f"x {b}"),
            (None, f"{rnd(50)}"), (2, c + " " + rnd(40) + " " + a), (None, b)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, S.report(df, window=12, gram=7, bits=1 << 20).collect()), key=str)
    named = brute([(i, t) for i, (_, t) in enumerate(docs)], 12)
    assert got == sorted(((docs[i][0], *x) for i, x in named.items()), key=str) and len(got) == 6


def test_places_beyond_the_low_bits():
    g = np.random.default_rng(1).integers(0, 6, 500, dtype=np.uint64) << np.uint64(40)
    for span in (1, 3, 8):
        want = [min(range(i, i + span), key=lambda j: (g[j], j)) for i in range(len(g) - span + 1)]
        assert S.places(g, span).tolist() == S.places(g, span, bits=4).tolist() == want
