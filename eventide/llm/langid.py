"""Language identification by mixture inference over hashed byte trigrams.

``fit`` counts, per language, the trigrams of all its training texts (ASCII
letters lowered, other ASCII bytes one class, trigrams centred on that class
left out; hashed to ``BUCKETS`` values) and returns smoothed likelihoods: a
table of a fixed number of values per language.

``predict`` treats a document as drawn from a mixture of languages.
Expectation-maximisation estimates its proportions over all languages; then
language sets grow from the best single language, taking the others in order
of those proportions, with the proportions estimated anew for each set, as long
as the penalised likelihood rises: log-likelihood / 3 (a byte is in three
trigrams) less ``PENALTY`` * log(n) / 2 for each language.  The prediction is
the language with the largest proportion, which is the score.

Defined cases: a text that is null or has no letter (a character of Unicode
category L; numerals are none) is ``und`` with score 0;
so is every text if nothing was learned.  A text with a letter but no trigram
gets the most frequent language of the training texts and its share.  Equal
proportions go to the smaller language code.  At most ``MAX_LANGS`` languages are
learned, the most frequent ones of the training rows, so that the model and
what EM holds are bounded however dirty the column is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import BLOCK_BYTES, LOWER, blocks, utf8
from .staging import free_name

BUCKETS = 1 << 15
MAX_LANGS = 256
SMOOTH, PENALTY, ROUNDS = 0.1, 2.0, 10
UNKNOWN = "und"
_FOLD = np.frombuffer(LOWER, np.uint8).copy()
_FOLD[[b for b in range(128) if not 97 <= _FOLD[b] <= 122]] = 32


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each row, bucket, count): each row's distinct trigrams, row by row."""
    first, codes, counts = np.zeros(len(off), np.int64), [], []
    f = _FOLD[data].astype(np.uint32)
    if len(f) > 2:
        x = f[:-2] * np.uint32(0x9E3779B1) + f[1:-1] * np.uint32(0x85EBCA77) + f[2:] * np.uint32(0xC2B2AE3D)
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        x >>= np.uint32(17)
        good = f[1:-1] != 32
        for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
            c = x[a:max(a, b - 2)][good[a:max(a, b - 2)]]
            if len(c) > 4096:
                n = np.bincount(c, minlength=BUCKETS)
                u = np.flatnonzero(n)
                n = n[u]
            else:
                u, n = np.unique(c, return_counts=True)
            codes.append(u.astype(np.int64))
            counts.append(n)
            first[i + 1] = first[i] + len(u)
    if not codes:
        return first, np.zeros(0, np.int64), np.zeros(0, np.float64)
    return first, np.concatenate(codes), np.concatenate(counts).astype(np.float64)


@dataclass
class Model:
    """Languages, their shares of the training texts, log likelihood of each bucket (buckets x languages)."""

    langs: list[str]
    share: np.ndarray
    logp: np.ndarray


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Likelihoods from all rows with a text and one of the ``MAX_LANGS`` most frequent languages (ties: smaller
    code); nothing else of them is looked at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for b in batches:
            off, data = utf8(b.column(0))
            langs = b.column(1).to_pylist()
            for lo, hi in blocks(off):
                first, code, n = trigrams(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                for i in range(lo, hi):
                    t = tables.setdefault(langs[i], np.zeros(BUCKETS, np.int64))
                    a, z = first[i - lo], first[i - lo + 1]
                    t[code[a:z]] += n[a:z].astype(np.int64)
                    docs[langs[i]] = docs.get(langs[i], 0) + 1
        for lang, t in tables.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * (len(at) + 1),
                                              "code": np.append(at, -1), "n": np.append(t[at], docs[lang])})

    rows = labelled.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).filter("t is not null and l is not null")
    common = [r["l"] for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l").limit(MAX_LANGS).collect()]
    got = rows.filter(F.col("l").isin(common)) \
        .mapInArrow(run, "lang string, code bigint, n bigint") \
        .groupBy("lang", "code").agg(F.sum("n").alias("n")).collect()  # at most languages x (buckets + 1)
    langs = sorted({r["lang"] for r in got})
    if not langs:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0)))
    at = {lang: i for i, lang in enumerate(langs)}
    n, share = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    for r in got:
        if r["code"] < 0:
            share[at[r["lang"]]] = r["n"]
        else:
            n[r["code"], at[r["lang"]]] = r["n"]
    n += SMOOTH
    return Model(langs, share / share.sum(), np.log(n / n.sum(axis=0)))


def _em(p: np.ndarray, n: np.ndarray, first: np.ndarray, pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) per row after some rounds; p: entries x languages, pi: rows x languages."""
    size, ones = np.diff(first), np.ones(p.shape[1])
    total = np.add.reduceat(n, first[:-1])
    for _ in range(rounds):
        each = np.repeat(pi, size, axis=0)
        each *= p
        w = n / (each @ ones)
        each *= w[:, None]
        pi = np.add.reduceat(each, first[:-1], axis=0) / total[:, None]
    each = np.repeat(pi, size, axis=0)
    each *= p
    return pi, np.add.reduceat(n * np.log(each @ ones), first[:-1])


def mixtures(model: Model, first: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Proportions (rows x languages) of rows that all have a trigram; 0 outside the chosen set."""
    k, rows = len(model.langs), len(first) - 1
    logp = model.logp[code]
    p = np.exp(logp - logp.max(axis=1, keepdims=True))
    total = np.add.reduceat(n, first[:-1])
    single = np.add.reduceat(n[:, None] * np.log(p), first[:-1], axis=0)
    best = single.argmax(axis=1)
    pi = np.zeros((rows, k))
    pi[np.arange(rows), best] = 1.0
    if k == 1:
        return pi
    all_pi, _ = _em(p, n, first, np.full((rows, k), 1.0 / k), ROUNDS)
    order = np.argsort(-all_pi, axis=1, kind="stable")
    reached, chosen = single[np.arange(rows), best] / 3, pi > 0
    live = np.arange(rows)
    penalty = PENALTY * np.log(np.maximum(total, 2)) / 2
    while len(live):
        nxt = np.array([next((c for c in order[r] if not chosen[r, c]), -1) for r in live])
        live, nxt = live[nxt >= 0], nxt[nxt >= 0]
        if not len(live):
            break
        chosen[live, nxt] = True
        size = np.diff(first)[live]
        f = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(first[:-1][live] - f[:-1], size) + np.arange(f[-1])
        start = np.where(chosen[live], all_pi[live] + 1e-6, 0.0)
        got, ll = _em(p[at], n[at], f, start / start.sum(axis=1, keepdims=True), ROUNDS)
        up = ll / 3 - penalty[live] > reached[live]
        chosen[live[~up], nxt[~up]] = False
        live, got, ll = live[up], got[up], ll[up]
        pi[live] = got
        reached[live] = ll / 3 - penalty[live]
    return pi


def judge(model: Model, data: np.ndarray, off: np.ndarray) -> list[tuple[str, float]]:
    """(language, score) of each row of a block of texts."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * (len(off) - 1)
    if not model.langs:
        return out
    first, code, n = trigrams(data, off)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        cut = np.concatenate((first[:-1][some], first[-1:]))
        pi = mixtures(model, cut - cut[0], code, n)
        top = pi.argmax(axis=1)
        score = np.clip(pi[np.arange(len(some)), top], 0.0, 1.0)
        for i, t, s in zip(some.tolist(), top.tolist(), score.tolist()):
            out[i] = (model.langs[t], s)
    common = int(model.share.argmax())
    letters = np.concatenate(([0], np.cumsum((_FOLD[data] < 128) & (_FOLD[data] != 32))))
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        if letters[b] == letters[a] and not any(map(str.isalpha, data[a:b].tobytes().decode("utf-8", "replace"))):
            out[i] = (UNKNOWN, 0.0)
        elif out[i][0] == UNKNOWN:
            out[i] = (model.langs[common], float(model.share[common]))
    return out


def _block(model: Model) -> int:
    """Bytes of text in a block, fewer the more languages there are: what EM holds is entries x languages."""
    return max(1 << 14, 4 * BLOCK_BYTES // max(4, len(model.langs)))


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None,
            lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``carry`` columns (all, if None) and the language and score of every whole text."""
    carry = list(docs.columns) if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField(lang_name, T.StringType()),
                           T.StructField(score_name, T.DoubleType())])

    extra = [] if text_col in carry else [text_col]  # a text that is carried anyway goes to Python once
    at = carry.index(text_col) if not extra else len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, data = utf8(b.column(at))
            out = [x for lo, hi in blocks(off, _block(shared.value))
                   for x in judge(shared.value, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(carry)], pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                names=[*carry, lang_name, score_name])

    return docs.select(*carry, *extra).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """True for the documents that nothing is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from those not held out."""
    model = fit(docs.filter(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model,
                   carry=["doc_id", "held_out"])


def known_language(docs: DataFrame) -> DataFrame:
    """The documents with a language; those judged ``und`` go.  All columns as they were."""
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    model = fit(docs.filter(~held_out()))
    return predict(docs, model, lang_name=lang, score_name=score).filter(F.col(lang) != UNKNOWN).drop(lang, score)
