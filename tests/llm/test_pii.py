import hashlib
import random
import re

import numpy as np
import pytest

from eventide.llm import pii as P

from .helpers import none, odd

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.findall("[0-9]", m)) <= 15)]


def luhn(d):
    s = [int(c) for c in d[::-1]]
    return (sum(s[::2]) + sum(sum(divmod(2 * x, 10)) for x in s[1::2])) % 10 == 0


def plain(text):
    return [(k, *m.span()) for k, (_, p, ok) in enumerate(PLAIN) for m in re.finditer(p, text) if ok(m.group())]


def test_base_spans_are_the_patterns():
    r = random.Random(2)
    bits = ["a.b", "@", "@x.com", "1.2.3.4", "256.1.1.1", ".", " ", "-", "+49 170 123456", "4539 1488 0343 6467", "4539148803436467",
            "12", "é", "(", ")", "x@y", "007.08.9.10", "+1", "_", "%", "9" * 30, "\n"]
    for _ in range(6000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert sorted(P.base_spans(t)) == sorted(plain(t)), repr(t)


def test_long_runs_are_linear():
    for t in ("9" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "1 " * 100_000):
        P.base_spans(t)


def weights():
    return P.learn([P.Mentions(t, P.base_spans(t)) for t in
                    ["mail a.b@c.com now", "call +49 170 1234567 or write a@b.org", "ref 12345678", "id 99887766 and x@y.net"] * 5])


def test_repeated_mention_gets_the_label():
    w = weights()
    t = "write to Ann.Lee@Mail.example.com today; later ann.lee(at)mail.example.com again, ref 12345678"
    base = P.base_spans(t)
    assert [(P.KINDS[k], t[a:b]) for k, a, b in P.added_spans(t, base, w)] == [("email", "ann.lee(at)mail.example.com")]
    t = "call +49 170 1234567 or just 49/170/1234567 but not 49/170/1234568"
    assert [(P.KINDS[k], t[a:b]) for k, a, b in P.added_spans(t, P.base_spans(t), w)] == [("phone", "49/170/1234567")]


def test_clean_text_gets_nothing():
    w = weights()
    for t in ("", "no data", "ref 12345678 and 12345678", "see a(at)b and 1/2/3456789"):
        assert P.base_spans(t) == [] and P.added_spans(t, [], w) == []


def test_similar_numbers_are_linked():
    w = weights()
    for t in ("call +49 170 1234567 or 0170 1234567", "call 0170 1234567, from abroad +49 170 1234567"):
        assert [(P.KINDS[k], t[a:b]) for k, a, b in P.added_spans(t, P.base_spans(t), w)] == [("phone", "0170 1234567")]


def test_field_needs_no_base_span():
    w, t = weights(), "mail q.r@localhost now, ref 12345678"
    assert P.base_spans(t) == []
    assert [(P.KINDS[k], t[a:b]) for k, a, b in P.added_spans(t, [], w)] == [("email", "q.r@localhost")]


def test_evidence_reaches_all_repeats():
    w = weights()
    for n in (30, 500):
        many = "and 49/170/1234567 " * n
        for t in (f"call +49 170 1234567 {many}", f"{many}call +49 170 1234567", f"{many}call +49 170 1234567 {many}"):
            got = P.added_spans(t, P.base_spans(t), w)
            assert {(P.KINDS[k], t[a:b]) for k, a, b in got} == {("phone", "49/170/1234567")}
            assert len(got) == t.count("49/170/1234567")


def exact(m, w):
    """Marginals by summing over all labellings."""
    n, k = len(m.spans), P.NONE + 1
    u = np.array([w.node[f].sum(axis=0) for f in m.features])
    total = np.zeros((n, k))
    for y in np.ndindex(*(k,) * n):
        if any(o >= 0 and o != v for o, v in zip(m.observed, y)):
            continue
        s = sum(u[i, v] for i, v in enumerate(y) if m.observed[i] < 0) + sum(w.edge[a, b] for a, b in zip(y, y[1:])) + sum(w.skip[y[a], y[b]] for a, b in m.skips)
        total += np.exp(s) * np.eye(k)[list(y)]
    return total / total.sum(axis=1, keepdims=True)


def test_messages_are_exact_on_a_chain_and_near_on_a_loop():
    r = np.random.default_rng(3)
    w = P.Weights(r.normal(0, 1, (P.N_FEATURES, P.NONE + 1)), r.normal(0, .5, (5, 5)), r.normal(0, .3, (5, 5)))
    w.edge, w.skip = w.edge + w.edge.T, w.skip + w.skip.T
    chain = "a 1234567 b 2345678 c +49 170 1234567 d"
    m = P.Mentions(chain, P.base_spans(chain))
    assert len(m.spans) == 3 and not m.skips
    assert np.allclose(P.marginals(m, w, 50), exact(m, w), atol=1e-3)
    loop = "a 1234567 b 2345678 c 1234567 d 3456789 e"
    m = P.Mentions(loop, [])
    assert m.skips == [(0, 2)]
    assert np.abs(P.marginals(m, w, 50) - exact(m, w)).max() < 0.15


def test_learned_weights_know_the_kinds():
    w = weights()
    p = P.marginals(P.Mentions("mail q.r@s.com now", []), w)
    assert p[0].argmax() == 0


def test_report_and_redact(spark):
    rows = [(1, "é a.b@c.com x 1.2.3.4"), (2, None), (3, ""), (4, "clean"), (4, "clean"), (5, "4539 1488 0343 6467 and +49 170 1234567")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(P.report(d).collect())
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 4, 5]
    for r, (_, t) in zip(got, rows):
        base = sorted(plain(t or ""))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for k, *_ in base) for i in range(4))
        s = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(s.encode()).hexdigest() and r.spans == s
    long = spark.createDataFrame([(1, "a.b@c.com, é", 12), (2, "clean", 99), (3, None, None)], "doc_id bigint, text string, n_chars bigint")
    assert sorted(map(tuple, P.redact(long).collect())) == [(1, "[EMAIL], é", 10), (2, "clean", 99), (3, None, None)]


def test_odd_and_empty_tables(spark):
    d = odd(spark)
    r = P.redact(d)
    assert r.columns == d.columns and r.schema == d.schema
    assert sorted(map(str, r.collect())) == sorted(map(str, d.collect()))
    assert P.report(none(spark)).count() == 0 and P.redact(none(spark)).count() == 0


def test_overlapping_spans_are_redacted_once():
    assert P.redacted("ab 123 cd", [(2, 3, 6), (3, 2, 5)]) == "ab[PHONE] cd"


@pytest.mark.parametrize("unit", ["a@", "@", "a@b.c@", "1@2", "(at)x"])
def test_marks_without_space_are_linear(unit):
    import time

    began = time.time()
    m = P.Mentions(unit * (100_000 // len(unit)), [])
    assert time.time() - began < 10 and len([k for k in m.keys if k]) <= 60_000


def test_marks_of_one_run_are_one_mention():
    m = P.Mentions("see (a@b@c), <x@y.z>; and '@' or @ q(at)r", [])
    assert m.spans == [(5, 10), (14, 19), (27, 28), (33, 34), (35, 41)]
