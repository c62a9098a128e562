"""Repeated passages by sparse suffixes, grouped instead of sorted.

Words are those of the decontamination operator.  A passage is repeated if it
has at least ``WINDOW`` words and stands in two documents; the result holds, per
document, the runs of words that repeated windows of ``WINDOW`` words cover.

Only suffixes at content-selected places are kept: in every window the least
hash of its ``GRAM``-word grams (the leftmost, if several) is its minimiser, so
equal windows, wherever they stand, have their minimiser at the same place.
No suffix array is built: where it would sort the suffixes and compare
neighbours, the suffixes are grouped by the gram that they begin with, and those
whose gram stands alone are dropped (a bit map of fixed size tells which recur,
see ``bitmaps``).  A record holds the windows that have its minimiser as theirs,
left and right of it.  Records with equal surroundings (by hash) repeat over all
their length.
A record whose surroundings are found in one document only is compared
window by window with the others, which gives its repeated part to the word.

Every step is a grouping or a join on a hash with map-side combining, so a
passage that a third of the documents share is no group that one task holds:
equal surroundings are counted first, and only different ones go on.

Defined cases: null has no words; a text of fewer than ``WINDOW`` words has no
passage; rows with one id count as one document, each row with a null id as one
of its own (with a result row of its own); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import _power, blocks, mix, utf8, words
from .bitmaps import bit_map, slot
from .decontam import IS_WORD, VALUES
from .staging import drop_staged, staged

WINDOW, GRAM = 50, 26
MAP_BITS = 1 << 27
_PLACE = 26  # low bits of a key that hold the place, so that a minimum knows where it stands


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        up, down = _power(len(h) + 1)
        p = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[:len(h)], dtype=np.uint64)))
        return mix((p[k:] - p[:-k]) * down[:n])


def least(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of the ``span`` values from each place, by doubling."""
    size = 1
    while 2 * size <= span:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (span - size)], x[span - size:]) if span > size else x


def places(g: np.ndarray, span: int, bits: int = _PLACE) -> np.ndarray:
    """Of the ``span`` grams from each place, the place of the least (by all but its low ``bits``; the leftmost)."""
    mask = np.uint64((1 << bits) - 1)
    if len(g) <= 1 << bits:
        return (least(g & ~mask | np.arange(len(g), dtype=np.uint64), span) & mask).astype(np.int64)
    # more places than the low bits tell apart: by rank, which orders them in the same way
    order = np.argsort(g & ~mask, kind="stable")
    rank = np.empty(len(g), np.int64)
    rank[order] = np.arange(len(g))
    return order[least(rank, span)]


class Records:
    """Records of a block: row, minimiser's gram, first window, number of windows; and all windows' hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray, window: int, gram: int):
        w = words(data, off, IS_WORD, VALUES)
        g = run_hashes(w.hashes, gram)
        self.windows = run_hashes(w.hashes, window)
        n = len(self.windows)
        empty = np.zeros(0, np.int64)
        self.row = self.first = self.size = empty
        self.gram = self.around = np.zeros(0, np.uint64)
        self.first_word = w.first
        if not n:
            return
        place = places(g, window - gram + 1)
        at = np.flatnonzero(w.row_end[:n] >= np.arange(n) + window)
        if not len(at):
            return
        row = np.searchsorted(w.first, at, side="right") - 1
        p = place[at]
        new = np.concatenate(([True], (p[1:] != p[:-1]) | (row[1:] != row[:-1])))
        cut = np.flatnonzero(new)
        self.row, self.first = row[cut], at[cut]
        self.size = np.diff(np.append(cut, len(at)))
        p = p[cut]
        self.gram = g[p]
        with np.errstate(over="ignore"):
            last = self.windows[self.first + self.size - 1]
            self.around = mix(self.windows[self.first] * np.uint64(0x9E3779B97F4A7C15) + mix(last)
                              + mix(self.gram + (p - self.first).astype(np.uint64) * np.uint64(64) + self.size.astype(np.uint64)))


def _grams(docs: DataFrame, text_col: str, window: int, gram: int) -> DataFrame:
    """(gram, n): the minimisers' grams with their number, combined in the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, data = utf8(b.column(0))
            for lo, hi in blocks(off):
                r = Records(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], window, gram)
                g, n = np.unique(r.gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return docs.select(text_col).mapInArrow(run, "gram bigint, n bigint")


def _records(docs: DataFrame, id_col: str, text_col: str, marks, bits: int, window: int, gram: int) -> DataFrame:
    """(doc, own, around, start, windows): the records whose gram may recur; start is a word's place in its
    document, own the number of a row without id."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc", kind), T.StructField("own", T.LongType()), T.StructField("around", T.LongType()),
                           T.StructField("start", T.LongType()), T.StructField("windows", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.frombuffer(marks.value, np.uint8)
        for b in batches:
            off, data = utf8(b.column(1))
            for lo, hi in blocks(off):
                r = Records(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], window, gram)
                s = r.gram.view(np.int64) % bits
                keep = np.flatnonzero(m[s >> 3] >> (s & 7) & 1)
                first, size = r.first[keep], r.size[keep]
                cut = np.concatenate(([0], np.cumsum(size)))
                at = np.repeat(first - cut[:-1], size) + np.arange(cut[-1])
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(r.windows[at].view(np.int64)))
                row = pa.array(r.row[keep] + lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(2).take(row), pa.array(r.around[keep].view(np.int64)),
                     pa.array(first - r.first_word[r.row[keep]]), lists], names=schema.fieldNames())

    own = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col), own.alias("own")).mapInArrow(run, schema)


_ENDS = ("lo", "hi", "own_lo", "own_hi")  # least and largest id and own number of a group's documents


def _several() -> Column:
    """Whether ``_ENDS`` are those of more than one document."""
    return F.coalesce(F.col("lo") != F.col("hi"), F.lit(False)) | F.coalesce(F.col("own_lo") != F.col("own_hi"), F.lit(False)) \
        | (F.col("lo").isNotNull() & F.col("own_lo").isNotNull())


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
            gram: int = GRAM, bits: int = MAP_BITS) -> DataFrame:
    """(doc, own, start, end): the words of each document that windows repeated in another document cover, as
    disjoint runs; own tells rows without id apart and is null for the others."""
    if not 0 < gram <= window:
        raise ValueError("gram must lie between 1 and window")
    spark = docs.sparkSession
    found = _grams(docs, text_col, window, gram).groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1")
    marks = spark.sparkContext.broadcast(bit_map(found.select(slot(F.col("gram"), bits).alias("slot")), bits))
    records = staged(_records(docs, id_col, text_col, marks, bits, window, gram))
    # written by itself, so that the join below has two plain shuffled sides and AQE can split a hot one
    holders = staged(records.groupBy("around").agg(
        F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min("own").alias("own_lo"), F.max("own").alias("own_hi")))
    known = staged(records.join(holders, "around").withColumn("same", _several()))
    drop_staged(records)
    drop_staged(holders)
    equal = known.filter("same").select("doc", "own", "start", (F.col("start") + F.size("windows") + (window - 1)).alias("end"))
    # windows of surroundings that one document has alone, against those of all others
    first = F.coalesce(F.col("doc") == F.col("lo"), F.col("lo").isNull() & (F.col("own") == F.col("own_lo")))
    one_each = known.filter(~F.col("same") | first)
    shared = one_each.select(*_ENDS, F.col("same"), F.explode("windows").alias("w")).groupBy("w") \
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("own_lo").alias("own_lo"),
             F.max("own_hi").alias("own_hi"), F.max((~F.col("same")).cast("int")).alias("asked")) \
        .filter(_several() & (F.col("asked") == 1)).select("w")
    part = known.filter(~F.col("same")).select("doc", "own", "start", F.posexplode("windows").alias("i", "w")).join(shared, "w") \
        .select("doc", "own", (F.col("start") + F.col("i")).alias("start"), (F.col("start") + F.col("i") + window).alias("end"))
    return merged(equal.unionByName(part))


def merged(runs: DataFrame) -> DataFrame:
    """Disjoint runs per document that cover the same words; a document's runs are bounded by its length."""
    by = W.partitionBy("doc", "own").orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1))
    new = F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")
    group = F.sum("new").over(by.rowsBetween(W.unboundedPreceding, 0))
    return runs.distinct().withColumn("new", new).withColumn("run", group).groupBy("doc", "own", "run") \
        .agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document with a repeated passage: its id, number of runs, of words in them, and the runs as text
    (start:end in words, end exclusive).  Documents without one have no row."""
    runs = repeats(docs, id_col, text_col, **options)
    spans = F.array_sort(F.collect_list(F.struct("start", "end")))
    return runs.groupBy("doc", "own").agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("end") - F.col("start")).alias("n_repeated"),
                                   spans.alias("s")) \
        .select(F.col("doc").alias(id_col), "n_spans", "n_repeated",
                F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"))
