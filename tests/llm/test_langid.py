import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import langid as L

from .helpers import LONG, none, odd, odd_rows

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.read.parquet(DOCS).filter(~L.held_out()))


def judge(model, texts):
    raws = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raws])))
    return L.judge(model, np.frombuffer(b"".join(raws), np.uint8), off)


def test_held_out_accuracy(spark):
    d = spark.read.parquet(DOCS)
    r = L.report(d).join(d.select("doc_id", "lang"), "doc_id")
    assert r.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    assert r.filter("score < 0 or score > 1 or score is null").count() == 0
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in r.collect())


def test_held_out_rows_teach_nothing(spark):
    d = spark.read.parquet(DOCS).select("doc_id", "text", "lang")
    changed = d.withColumn("lang", F.when(L.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, L.report(x).collect())) for x in (d, changed))
    assert a == b


def test_counts_are_the_definition(spark):
    rows = [("abc abd", "x"), ("ABC", "x"), ("zzzz", "y"), (None, "y"), ("abc", None), ("", "y")]
    m = L.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert m.langs == ["x", "y"] and np.allclose(m.share, [0.5, 0.5])
    n = np.exp(m.logp)
    assert np.allclose(n.sum(axis=0), 1)
    # x holds abc twice and 8 other trigrams (ab_ is none: its text ends), y holds zzz twice
    total_y = L.BUCKETS * L.SMOOTH + 2
    assert np.isclose(n[:, 1].max(), (2 + L.SMOOTH) / total_y)


def test_proportions_are_the_likeliest(model):
    """EM ends where a grid over two languages has its maximum."""
    i, j = model.langs.index("en"), model.langs.index("de")
    r = np.random.default_rng(1)
    code = np.concatenate([r.choice(L.BUCKETS, 600, p=np.exp(model.logp[:, i]) / np.exp(model.logp[:, i]).sum()),
                           r.choice(L.BUCKETS, 300, p=np.exp(model.logp[:, j]) / np.exp(model.logp[:, j]).sum())])
    code, n = np.unique(code, return_counts=True)
    p = np.exp(model.logp[code][:, [i, j]])
    pi, _ = L._em(p, n.astype(float), np.array([0, len(code)]), np.full((1, 2), 0.5), 300)
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax([(n * np.log(p @ [g, 1 - g])).sum() for g in grid])]
    assert abs(pi[0, 0] - best) < 0.01 and 0.5 < pi[0, 0] < 0.8


def test_mixed_document_gets_both_languages(spark, model):
    d = {x.lang: x.text for x in spark.read.parquet(DOCS).filter("length(text) > 3000").collect()}
    text = d["en"][:2500] + " " + d["fr"][:1200]
    raw = text.encode()
    first, code, n = L.trigrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    pi = dict(zip(model.langs, L.mixtures(model, first, code, n)[0]))
    assert {k for k, v in pi.items() if v > 0} == {"en", "fr"} and pi["en"] > pi["fr"] > 0.15


def test_block_position_changes_nothing(model):
    texts = ["Thing of the and tion ", "", "ñ", "De la los que ", "12", "Der die und sich "]
    assert judge(model, texts) == [judge(model, [t])[0] for t in texts]


def test_odd_rows(spark):
    got = {r.doc_id: r for r in L.report(odd(spark)).collect() if r.doc_id not in (6, None)}
    for i, t, *_ in odd_rows():
        if i in got:
            letter = any(c.isalpha() for c in t or "")
            assert (got[i].lang_pred == "und") == (not letter), (i, got[i])
            assert letter or got[i].score == 0
    assert L.report(none(spark)).count() == 0
    kept = L.known_language(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5, 6, 6, 7, 9, 10]
    assert max(len(r.text) for r in kept.collect()) == len(LONG)


def test_nothing_learned(spark):
    d = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert [(r.lang_pred, r.score) for r in L.report(d).collect()] == [("und", 0.0)]


@pytest.mark.parametrize("text", ["½", "² ³", "Ⅻ", "٣٤", "1 2 3 _", "日本", "ª", "é"])
def test_only_letters_make_a_language(model, text):
    import unicodedata

    letter = any(unicodedata.category(c)[0] == "L" for c in text)
    assert (judge(model, [text])[0][0] != "und") == letter


def test_a_dirty_language_column_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGS", 5)
    rows = [(f"text number {i} with words", f"x{i:04}" if i % 3 else ("en", "fr")[i % 2]) for i in range(600)]
    m = L.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert m.langs == ["en", "fr", "x0001", "x0002", "x0004"]
