import random

import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import simhash as S

from .helpers import none, odd, odd_rows, prose


def brute_fp(text, k=3):
    b = (text or "").encode().lower()
    w = [x for x in b.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if x]
    if not w:
        return 0
    sh = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(rows, most=2):
    """rows: (id, fp) -> {id: smallest id reachable}"""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= most:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return {rows[i]: least.get(root(i)) for i in range(len(rows))}


def test_fingerprint_is_the_definition(spark):
    texts = prose(1, 60) + [t for _, t, *_ in odd_rows()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.fingerprint for r in S.fingerprints(df).select("doc_id", S.hex16(F.col("fp")).alias("fingerprint")).collect()}
    assert got == {i: f"{brute_fp(t):016x}" for i, t in enumerate(texts)}


def test_spark_xxhash64_agrees(spark):
    r = spark.sql("select xxhash64('a b c') h").first()["h"]
    assert r % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("bucket", [1, 2, 64])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_give_the_components_of_all_pairs(spark, bits, bucket):
    r = random.Random(bits)
    fps = {0, 1, 3, 2**64 - 1, 2**63}
    for _ in range(12):
        base = r.getrandbits(64)
        for _ in range(r.randint(1, 25)):  # walks in steps of up to four bits
            base ^= sum(1 << r.randrange(64) for _ in range(r.randint(0, 4))) % 2**64
            fps.add(base)
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    parent = {f: f for f in signed}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for e in S.links(df, bits, bucket).collect():
        parent[root(e.a)] = root(e.b)
    want = brute_classes(list(zip(fps, fps)), bits)
    got = {}
    for f, s in zip(fps, signed):
        got.setdefault(root(s), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(
        sorted(f for f in fps if want[(f, f)] == c) for c in set(want.values()))


def test_components_on_odd_rows(spark):
    got = S.components(odd(spark)).collect()
    rows = [(r.doc_id, r.fp % 2**64) for r in got]
    want = brute_classes(rows)
    assert len(got) == len(odd_rows())
    assert all(r.component_id == want[(r.doc_id, r.fp % 2**64)] for r in got)
    assert S.components(none(spark)).count() == 0


def test_keep_first_keeps_columns_and_one_row_a_class(spark):
    docs = odd(spark)
    kept = S.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 5, 6} <= set(ids) and not {2, 3, 7} & set(ids)
    assert S.keep_first(none(spark)).count() == 0


def test_keep_first_keeps_null_ids_and_shared_ids_of_different_classes(spark):
    alone = [t for t in prose(5, 60, most=40) if len(t.split()) > 20][:12]
    assert all((brute_fp(a) ^ brute_fp(b)).bit_count() > 2 for i, a in enumerate(alone) for b in alone[:i])
    rows = [(None, t) for t in alone[:8]]  # each alone in its class
    rows += [(None, alone[8]), (1, alone[8]), (None, alone[0])]  # copies with null ids
    rows += [(2, alone[9]), (2, alone[10]), (3, alone[10]), (2, alone[9])]  # an id with two texts
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, S.keep_first(df).collect()), key=str)
    assert got == sorted([(None, t) for t in alone[:8]] + [(1, alone[8]), (2, alone[9]), (2, alone[10])], key=str)


def test_thousands_of_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two three four five").alias("text"))
    got = S.components(docs).agg(F.countDistinct("component_id").alias("n"), F.max("component_id").alias("m")).first()
    assert (got.n, got.m) == (1, 0)
