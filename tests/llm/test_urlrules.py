import itertools
import math
import random

import pytest
from eventide.llm import urlrules as U
from pyspark.sql import functions as F

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
SCHEMA = "page_id bigint, url string, html string, host string, path string, tokens string, fixed string, confidence string"


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
    return host, rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "https://A.Example.COM/en/x?y#z", "http://www.example.com/en/", "http://notexample.com/en/", "x://com", "x://com/",
        "http://a.net/es/1", "http://net/es/", "http://a.net/es", "http://a.net?q=/es/", "http://a.net#x/", "http://a://b/c", "http://É.com/É", "://h/p", "http://a.net/es/" * 40]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, None, "h", "p", "t", "f", "c") for i, u in enumerate(urls)], SCHEMA)


def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, b boolean")


def test_hosts_paths_and_fixed_rules(spark):
    got = U.judge(pages(spark, URLS), no_labels(spark), RULES).orderBy("page_id").collect()
    for r, u in zip(got, URLS):
        h, p = plain(u)
        name, verdict = rule(h, p)
        assert (r.host, r.path, r.rule, r.verdict) == (h, p, name, verdict or "allow"), u
    assert U.judge(pages(spark, []), no_labels(spark), RULES).count() == 0


def labelled(spark):
    r = random.Random(1)
    urls, bad = [], []
    for _ in range(600):
        host = r.choice(["casino.example.org", "news.example.org", "shop.example.org"])
        seg, key = r.choice(["win", "post", "a1"]), r.choice(["", "?ref=x", "?utm=y"])
        urls.append(f"http://{host}/{seg}/{r.randint(1, 999)}{key}")
        bad.append(host.startswith("casino") and seg == "win" and r.random() < .95 or r.random() < .02)
    df = pages(spark, urls)
    labels = spark.createDataFrame([(i, b) for i, b in enumerate(bad) if i % 3] + [(7, None), (9999, True)], "doc_id bigint, b boolean")
    return urls, df, labels


def with_tokens(df):
    host, path = U.parsed(F.col("url"))
    rows = df.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    return rows.withColumn("tokens", U.tokens(F.col("url"), F.col("host"), F.col("path")))


def plain_rules(data, min_blocked, min_confidence, min_lift, min_evidence, max_items=4):
    """Every itemset of at most max_items tokens that meets the limits, without those that a part of them beats."""
    base = sum(b for _, b in data) / len(data)
    found = {}
    for s in {frozenset(c) for t, b in data if b for k in range(1, max_items + 1) for c in itertools.combinations(sorted(t), k)}:
        have = [b for t, b in data if s <= t]
        n, k = len(have), sum(have)
        c = k / n
        evidence = k * math.log(c / base) + ((n - k) * math.log((1 - c) / (1 - base)) if k < n else 0)
        if k >= min_blocked and c >= min_confidence and c / base >= min_lift and evidence >= min_evidence:
            found[s] = c
    one = {t for s in found if len(s) == 1 for t in s}
    found = {s: c for s, c in found.items() if len(s) == 1 or not s & one}
    return {s: c for s, c in found.items() if not any(o < s and found[o] >= c for o in found)}


def test_mined_rules_are_brute_force(spark):
    urls, df, labels = labelled(spark)
    rows = with_tokens(df).join(labels.filter("b is not null").groupBy("doc_id").agg(F.max("b").alias("blocked")), F.col("page_id") == F.col("doc_id"))
    data = [(frozenset(r.tokens), r.blocked) for r in rows.collect()]
    for limits in ((5, .8, 1.5, 14.0), (3, .5, 1.2, 2.0)):
        got = {frozenset(r.rule): r.confidence for r in U.mined(rows, *limits).collect()}
        want = plain_rules(data, *limits)
        assert want and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_planted_hosts_are_blocked(spark):
    urls, df, labels = labelled(spark)
    got = U.judge(df, labels, RULES).orderBy("page_id").collect()
    assert [r.verdict for r in got] == ["block" if "casino" in u and "/win/" in u else "allow" for u in urls]
    again = U.judge(df.unionByName(df), labels, RULES)
    assert again.count() == 2 * len(urls)


def test_every_part_of_a_long_url_is_a_token(spark):
    df = pages(spark, ["http://" + "a." * 50 + "com/" + "".join(f"b{chr(97 + i % 26)}{chr(97 + i // 26)}/" for i in range(500))
                       + "?" + "&".join(f"k{i}=1" for i in range(500)) + "#f"])
    t = with_tokens(df).first().tokens
    assert len(t) == 51 + 500 + 500 + 1 == len(set(t))


@pytest.mark.parametrize("bad", ["third segment", "third key", "fourth label", "far pair"])
def test_deep_tokens_are_mined(spark, bad):
    r = random.Random(2)
    urls, labels = [], []
    for i in range(1500):
        w = r.random() < .03
        segs = [r.choice(["news", "blog", "shop"]) for _ in range(2)] + ["casino" if w and bad == "third segment" else r.choice(["x", "y"])]
        keys = ["a", "b", "win" if w and bad == "third key" else "c"]
        host = ("bet" if w and bad == "fourth label" else r.choice("pq")) + ".s1.example.org"
        if bad == "far pair":
            first, last = (True, True) if w else r.choice([(True, False), (False, True), (False, False)])
            segs, keys = ["one" if first else "uno"] + segs, keys + ["two" if last else "dos"]
        urls.append(f"http://{host}/{'/'.join(segs)}/{i}?{'&'.join(k + '=1' for k in keys)}")
        labels.append((i, w))
    got = U.judge(pages(spark, urls), spark.createDataFrame(labels, "doc_id bigint, b boolean"), []).orderBy("page_id").collect()
    assert [x.verdict == "block" for x in got] == [w for _, w in labels]


def test_a_small_host_is_blocked_in_a_large_table(spark):
    urls = [f"http://h{i % 300}.example.org/p{chr(97 + i % 26)}/{i}" for i in range(4000)] + [f"http://bad.example.net/x{i}" for i in range(6)]
    labels = spark.createDataFrame([(i, i >= 4000) for i in range(len(urls))], "doc_id bigint, b boolean")
    got = U.judge(pages(spark, urls), labels, []).filter("verdict = 'block'").collect()
    assert sorted(r.page_id for r in got) == list(range(4000, 4006))
