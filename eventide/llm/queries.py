"""Bindings of the corpus operators to the driver tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import load
from . import bpe, decontam, hilbert, langid, merkle, mixing, periods, pii, simhash, suffixes, tokenfile, topk, urlrules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return deco


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocab_path() -> str:
    """The public byte-level vocabulary that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op1_langid")
def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(load(spark, sf_dir, "documents"))


@register("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(load(spark, sf_dir, "documents"))


@register("op3_top_k", """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x FROM embeddings
           WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""")
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.filter("vec_id % 50 = 0"))


@register("op4_bpe")
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(load(spark, sf_dir, "documents"), vocab_path(), digest=True)


@register("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(load(spark, sf_dir, "documents"), vocab_path(), end_id=2)


@register("op6_decontaminate", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
         FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
          FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
hits AS (SELECT doc_id, i, wins.n, item FROM grams JOIN wins USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@register("op7_repeats")
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(load(spark, sf_dir, "documents"))


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


@register("op8_url_rules")
def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document with its id: blocked if it is toxic."""
    labels = load(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("blocked"))
    return urlrules.judge(load(spark, sf_dir, "pages"), labels, URL_RULES)


@register("op9_hilbert_shards")
def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard(load(spark, sf_dir, "documents"))


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(load(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@register("op11_mix_sources")
def op11_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(load(spark, sf_dir, "documents"))


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(load(spark, sf_dir, "documents"))


# CRC-32 of the id's decimal digits, from the table of its polynomial
_CRC = """crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(b AS BIGINT))) AS t),
crcs AS (SELECT doc_id, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, x: xor(t[1 + xor(c % 256, x)], c // 256), CAST(4294967295 AS BIGINT)), 4294967295) AS h
    FROM (SELECT DISTINCT doc_id FROM documents), crc_table)"""


def _leaf_sql(text: str) -> str:
    return "sha256(concat(" + ", ".join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"


@register("op13_merkle", rf"""
WITH RECURSIVE {_CRC},
leaves AS (SELECT d.doc_id, lang, {_leaf_sql('text')} AS leaf,
                  CASE WHEN h % 3 = 0 THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS claim
           FROM documents d LEFT JOIN crcs USING (doc_id)),
placed AS (SELECT *, row_number() OVER w - 1 AS p, count(*) OVER (PARTITION BY lang) AS n FROM leaves
           WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
lv AS (SELECT 0 AS k, lang, p, n, leaf AS h FROM placed
       UNION ALL
       SELECT k + 1, lang, p // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY p)) FROM lv WHERE n > 1 GROUP BY k, lang, p // 8),
subs AS (SELECT k AS top, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM lv WHERE n = 1),
tv AS (SELECT 0 AS k, p, n, h FROM subs
       UNION ALL
       SELECT k + 1, p // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY p)) FROM tv WHERE n > 1 GROUP BY k, p // 8),
sides AS (SELECT a.k, a.lang, a.p, coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
                 coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS r
          FROM lv a JOIN lv b ON a.k = b.k AND a.lang IS NOT DISTINCT FROM b.lang AND a.p // 8 = b.p // 8 WHERE a.n > 1 GROUP BY ALL),
tops AS (SELECT a.k, a.p, coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
                coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS r
         FROM tv a JOIN tv b ON a.k = b.k AND a.p // 8 = b.p // 8 WHERE a.n > 1 GROUP BY ALL),
way AS (SELECT d.lang, d.p, s.k, s.l, s.r FROM placed d JOIN sides s ON s.lang IS NOT DISTINCT FROM d.lang AND s.p = d.p // CAST(8 ** s.k AS BIGINT)
        UNION ALL
        SELECT d.lang, d.p, u.top + t.k, t.l, t.r FROM placed d JOIN subs u ON u.lang IS NOT DISTINCT FROM d.lang
        JOIN tops t ON t.p = u.p // CAST(8 ** t.k AS BIGINT)),
paths AS (SELECT lang, p, list({{'l': l, 'r': r}} ORDER BY k) AS path, string_agg(l || r, '' ORDER BY k) AS proof FROM way GROUP BY lang, p)
SELECT doc_id, leaf, u.h AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
       list_reduce(list_transform(coalesce(path, []), lambda x: x.l || '|' || x.r), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2)),
                   coalesce(claim, leaf)) AS folded_root, folded_root = root AS verified
FROM placed d JOIN subs u ON u.lang IS NOT DISTINCT FROM d.lang CROSS JOIN (SELECT h AS root FROM tv WHERE n = 1)
LEFT JOIN paths q ON q.lang IS NOT DISTINCT FROM d.lang AND q.p = d.p
""")
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(load(spark, sf_dir, "documents"))
