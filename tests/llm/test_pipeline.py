import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from eventide.llm import langid, pii

from .test_bpe import library
from .test_decontam import brute as hits
from .test_simhash import brute_classes, brute_fp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A table directory: sf0.001, less long texts, with odd rows added."""
    at = str(tmp_path_factory.mktemp("sf"))
    d = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 3000")
    more = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "1234 +- 99", "en", "s", 10),
                                  (9004, "write a.b@c.com or call +49 170 1234567 soon", "en", "s", 44)], d.schema)
    d.unionByName(more).coalesce(2).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").coalesce(1).write.parquet(f"{at}/benchmark.parquet")
    return at


def test_stages_against_plain_versions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    lang = {r.doc_id: r.lang_pred for r in langid.report(docs).collect()}
    rows = {i: r for i, r in rows.items() if lang[i] != "und"}
    one = C.STAGES[0][1](spark, docs, small)
    assert one.columns == columns and {r.doc_id: r for r in one.collect()} == rows
    assert not {9001, 9002, 9003} & rows.keys()

    fps = [(i, brute_fp(r.text)) for i, r in rows.items()]
    first = brute_classes(fps)
    rows = {i: rows[i] for i, f in fps if first[(i, f)] == i}
    two = C.STAGES[1][1](spark, one, small)
    assert two.columns == columns and {r.doc_id: r for r in two.collect()} == rows

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = {i: n for i, _, n, _ in hits([(i, r.text) for i, r in rows.items()], items)}
    rows = {i: r for i, r in rows.items() if not found[i]}
    three = C.STAGES[2][1](spark, two, small)
    assert three.columns == columns and {r.doc_id: r for r in three.collect()} == rows

    four = C.STAGES[3][1](spark, three, small)
    got = {r.doc_id: r for r in four.collect()}
    assert four.columns == columns and got.keys() == rows.keys()
    for i, r in rows.items():
        base = pii.base_spans(r.text)
        if not base:
            assert got[i] == r
        else:
            assert got[i].text != r.text and not pii.base_spans(got[i].text) and got[i].n_chars == len(got[i].text)
    assert got[9004].text == "write [EMAIL] or call [PHONE] soon"

    five = {r.doc_id: r for r in C.STAGES[4][1](spark, four, small).collect()}
    assert five.keys() == rows.keys()
    for i, r in got.items():
        ids, text = library(r.text)
        assert (five[i].n_tokens, five[i].decoded_sha256) == (len(ids), hashlib.sha256(text.encode()).hexdigest())

    whole = {r.doc_id: r for r in C.run(spark, small).collect()}
    assert whole == five


def test_empty_documents(spark, tmp_path):
    at = str(tmp_path)
    d = spark.read.parquet(f"{SF}/documents.parquet").filter(F.lit(False))
    d.write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").coalesce(1).write.parquet(f"{at}/benchmark.parquet")
    assert C.run(spark, at).count() == 0
