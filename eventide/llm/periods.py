"""Runs of periodic words, by a dictionary of basic factors.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) and at least ``max(least, times * q)`` words.

For each power of two L, the factors of L words get names (equal names: equal
factors), those of 2L from the pairs of names L apart.  Occurrences of a factor
in a window of 2L words form an arithmetic progression whose step is a
period.  So the distance from an occurrence to its successor, where it is at
most L, proposes a period, and that of every run with L / 2 < q <= L shows at
each of its places up to q + L words before its end: the factor there is at
least as long as the period, so no nearer successor exists.  Places in a row
with one distance are one proposal; it is extended word by word to both sides,
checked, and deduplicated.

Names are exact (no hashes): words are numbered per document, pairs by sorting.
A factor that its document holds once has no successor, nor has any longer one
that begins or ends with it, so its place leaves the dictionary.

Texts are worked through in blocks of whole documents, each seen once and
whole; nothing is shuffled.

Defined cases: a null or empty text has no words, no run and an empty collapsed
text; equal rows give equal results, a row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import blocks, utf8

LEAST, TIMES = 6, 4


def _named(keys: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the places ``at`` by their keys, -1 where a key stands alone; and the pairs (place, next place
    with its key)."""
    order = np.argsort(keys, kind="stable")  # places ascend, so those of a key do
    k, p = keys[order], at[order]
    new = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.zeros(0, bool)
    name = np.cumsum(new) - 1
    alone = new & np.concatenate((new[1:], [True])) if len(k) else new
    names = np.full(size, -1, np.int64)
    names[p[~alone]] = name[~alone]
    follows = np.flatnonzero(~new)
    return names, p[follows - 1], p[follows]


def runs(words: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of every run, by document, start and period.  ``words``: a number for
    each word, the same only for equal words of one document; ``first``: each document's first word and the end."""
    if times < 3:
        raise ValueError("a run of fewer than three periods may show none of them to a factor of power-of-two length")
    n = len(words)
    end = np.repeat(first[1:], np.diff(first))  # per word, the end of its document
    most = int(np.diff(first).max(initial=0)) // times  # the longest period that a run here may have
    found: set[tuple[int, int, int]] = set()
    names, a, b = _named(words, np.arange(n), n)
    size = 1
    while size // 2 < most and len(a):
        near = (b - a <= size) & (b - a > size // 2)
        p, q = a[near], (b - a)[near]
        order = np.argsort(p)
        p, q = p[order], q[order]
        cut = np.flatnonzero((np.diff(p) != 1) | (np.diff(q) != 0) | (end[p[1:]] != end[p[:-1]])) + 1
        lo = np.concatenate(([0], cut)).astype(np.int64)[:len(p)]
        hi = np.append(cut, len(p))[:len(lo)] - 1
        # places of a run that show its period: all but the last q + size - 1
        for x, y in zip(lo.tolist(), hi.tolist()) if len(p) else ():
            d = int(q[x])
            if p[y] - p[x] + d + size < max(least, times * d):
                continue
            s, e = int(p[x]), int(p[y]) + d + size
            stop = int(end[s])
            base = int(first[np.searchsorted(first, s, side="right") - 1])
            while s > base and words[s - 1] == words[s - 1 + d]:
                s -= 1
            while e < stop and words[e] == words[e - d]:
                e += 1
            if e - s >= max(least, times * d):
                found.add((s, e - s, d))
        # names of twice the length, where both halves recur
        at = np.flatnonzero(names[:max(0, n - size)] >= 0)
        at = at[(names[at + size] >= 0) & (at + 2 * size <= end[at])]
        names, a, b = _named(names[at] * (n + 1) + names[at + size], at, n)
        size *= 2
    out = []
    for s, length, d in found:
        doc = int(np.searchsorted(first, s, side="right")) - 1
        out.append((doc, s - int(first[doc]), length, d))
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def kept(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when each run (start, length, period) gives up all but its first period."""
    stay = np.ones(n, bool)
    for s, length, d in spans:
        stay[s + d:s + length] = False
    return stay


RUNS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                                 T.StructField("period", T.LongType())]))


def find(docs: DataFrame, carry: list[str], text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row the ``carry`` columns, ``n_words``, ``runs`` (start, length and period in words, by start and
    period) and ``collapsed`` (the words that no run drops, joined by one space)."""
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS),
                           T.StructField("collapsed", T.StringType())])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, data = utf8(b.column(0))
            for lo, hi in blocks(off):
                split = [data[off[i]:off[i + 1]].tobytes().split() for i in range(lo, hi)]  # at space and 0x09-0x0D
                first = np.concatenate(([0], np.cumsum([len(w) for w in split])))
                numbers: list[int] = []
                for ws in split:  # numbers go on from document to document, so no factor has a namesake in another
                    at, base = {}, len(numbers)
                    numbers += [at.setdefault(w, base + len(at)) for w in ws]
                spans: list[list[tuple[int, int, int]]] = [[] for _ in split]
                for doc, *r in runs(np.array(numbers, np.int64), first, least, times):
                    spans[doc].append(tuple(r))
                text = [b" ".join([w for w, k in zip(ws, kept(len(ws), s)) if k] if s else ws) for ws, s in zip(split, spans)]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in b.columns[1:]), pa.array(np.diff(first), pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in s] for s in spans], kind),
                     pa.array(text, pa.binary()).cast(pa.string())], names=schema.fieldNames())

    return docs.select(F.col(text_col), *carry).mapInArrow(run, schema)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with the words of every tenth document (by the CRC-32 of its id) periodic from one place on."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), h.alias("h"))
    cut = base.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w").cast("bigint")) \
              .withColumn("g", F.expr("h div 10")) \
              .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))) \
              .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    made = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.element_at("w", (F.col("a") + (i - F.col("a")) % F.col("p") + 1).cast("int"))))
    return cut.select("id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_runs, the longest run's start, length, period and exponent_milli, and the digests of
    all runs and of the collapsed text; in every tenth document words are made periodic first (``planted``)."""
    found = find(planted(docs, id_col, text_col), ["id"])
    # by length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    b = F.col("best")
    return found.withColumn("best", best).select(
        F.col("id").alias(id_col), F.size("runs").cast("bigint").alias("n_runs"), (-b["start"]).alias("start"), b["length"].alias("length"),
        (-b["period"]).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
