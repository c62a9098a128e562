import random
import re

from pyspark.sql import functions as F

from eventide.llm import decontam as D

from .helpers import none, odd, odd_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if n else ():
            wins.setdefault((n, tuple(w[s:s + n])), set()).add(str(i))
    out = []
    for i, t in docs:
        w = split(t)
        hit, found = set(), set()
        for n in {k[0] for k in wins}:
            for s in range(len(w) - n + 1):
                k = (n, tuple(w[s:s + n]))
                if k in wins:
                    hit.update(range(s, s + n))
                    found |= wins[k]
        out.append((i, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=str)


def case(seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["É", "naïve", "x1"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 3, 7, 9, 10, 11, 25])))) for i in range(30)]
    items += [(90, None), (91, "..."), (1, "Same Id, other text here"), (92, "the " * 40)]
    docs = []
    for i in range(80):
        t = []
        for _ in range(r.randint(0, 6)):
            w = split(r.choice(items)[1])
            a = r.randint(0, max(0, len(w) - 1))
            t += r.choice([w, w[a:], w[:a], [r.choice(vocab) for _ in range(r.randint(1, 30))]])
        docs.append((i, r.choice([" ", ", ", "\n"]).join(t)))
    return docs + [(100, None), (101, ""), (102, "THE, the; " * 9), (102, "THE, the; " * 9)], items


def got(report):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in report.collect()), key=str)


def digest(spark, rows):
    import hashlib
    return sorted(((a, b, c, hashlib.sha256(s.encode()).hexdigest()) for a, b, c, s in rows), key=str)


def test_report_is_the_definition(spark):
    docs, items = case()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    assert got(D.report(d, b)) == digest(spark, brute(docs, items))


def test_blocks_of_items_change_nothing(spark):
    docs, items = case(2)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    m = D.mark(d, b, carry=["doc_id"], block_bytes=400)
    one = D.mark(d, b, carry=["doc_id"])
    key = lambda df: sorted(((r.doc_id, r.found.n_words, r.found.starts, r.found.ends, r.found["items"]) for r in df.collect()), key=str)
    assert key(m) == key(one)


def test_odd_rows_and_empty_tables(spark):
    b = spark.createDataFrame([("a", "The cat sat on the mat the cat sat on the mat")], "item_id string, text string")
    docs = odd(spark)
    kept = D.clean(docs, b)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 8, 9, 10]
    assert D.report(none(spark), b).count() == 0
    empty = spark.createDataFrame([], "item_id string, text string")
    assert D.report(docs, empty).filter("contaminated").count() == 0
    assert D.report(docs, empty).count() == len(odd_rows())
    rows = [(i, t) for i, t, *_ in odd_rows()]
    want = digest(spark, brute(rows, [("a", "The cat sat on the mat the cat sat on the mat")]))
    assert got(D.report(docs, b)) == want
    assert D.report(docs, b).select(F.sum("n_hit")).first()[0] == 3 * 180


def test_items_without_id_are_those_of_the_sql(spark, tmp_path):
    import duckdb

    from eventide.llm.queries import ORACLES
    docs, items = case(3)
    long = " ".join(f"n{i}" for i in range(14))
    docs += [(110, f"begin {long} end"), (111, f"{long} {items[5][1]} {items[7][1]}"), (112, "lone words here")]
    items += [(None, long), (None, "lone words"), (None, None), (95, "n3 n4")]
    d = spark.createDataFrame([x for i, x in enumerate(docs) if x not in docs[:i]], "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    db = duckdb.connect()
    for name, df in (("documents", d), ("benchmark", b)):
        df.write.parquet(f"{tmp_path}/{name}")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    want = sorted(db.execute(ORACLES["op6_decontaminate"]).fetchall(), key=str)
    assert sum(r[5] for r in want if r[0] in (110, 111, 112)) == 3
    assert sorted(map(tuple, D.report(d, b).collect()), key=str) == want
    blocked = D.mark(d, b, carry=["doc_id"], block_bytes=300)
    assert sorted((r.doc_id, len(r.found["items"])) for r in blocked.collect()) == sorted((r[0], r[3]) for r in want)
    assert not {110, 111, 112} & {r.doc_id for r in D.clean(d, b).collect()}
