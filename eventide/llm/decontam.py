"""Benchmark decontamination by winnowing.

Words are runs of bytes that are digits, letters a-z (A-Z are lowered) or
part of a non-ASCII character.  A window is ``WINDOW`` consecutive words of an
item; an item of fewer words, but not none, is one window.  A document word
inside any occurrence of a window is hit.

Winnowing (Schleimer, Wilkerson and Aiken, 2003): of every run of
w = WINDOW - GRAM + 1 consecutive k-grams of a document, the least hash is
kept, so each shared span of w + k - 1 = WINDOW words keeps at least one
k-gram.  The kept fingerprints are joined with all k-grams of the items; around
each meeting the hit is extended: every window that holds it is compared with
the items' windows, first by hash and then word by word.  Windows of shorter
items, which the guarantee doesn't reach, are compared at every position.

The items are cut into blocks of at most ``block_bytes`` of text, and each
block's index is broadcast by itself, so what is broadcast is bounded at every
size of the benchmark.  With one block, documents are read once and nothing is
shuffled; with more, the blocks' findings are united per document.

Defined cases: null text has no words; an item without words has no window;
items with one id count as one item; those with a null id too, which adds one
to n_items and nothing to the list of ids; repeated documents give repeated
rows; an empty benchmark hits nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import LOWER, Words, blocks, byte_values, gram_sums, utf8, words
from .staging import free_name, staged

WINDOW, GRAM = 10, 5
BLOCK_BYTES = 16 << 20

IS_WORD = np.zeros(256, bool)
IS_WORD[np.r_[0x30:0x3A, 0x41:0x5B, 0x61:0x7B, 0x80:0x100]] = True
VALUES = byte_values(LOWER, 6)
_TABLE = 1 << 20

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType()))])


def _table(keys: np.ndarray) -> np.ndarray:
    t = np.zeros(_TABLE, bool)
    t[(keys & np.uint64(_TABLE - 1)).astype(np.int64)] = True
    return t


def _member(h: np.ndarray, keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Positions of ``h`` whose value is among the sorted ``keys``."""
    at = np.flatnonzero(table[(h & np.uint64(_TABLE - 1)).astype(np.int64)])
    if not len(at):
        return at
    k = np.searchsorted(keys, h[at])
    k[k == len(keys)] = 0
    return at[keys[k] == h[at]]


class Index:
    """What a task needs of a block of items: k-grams, windows by length, and who holds them."""

    def __init__(self, ids: list[str | None], texts: list[str]):
        raws = [(t or "").encode() for t in texts]
        off = np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64)
        self.data = np.frombuffer(b"".join(raws), np.uint8)
        w = words(self.data, off, IS_WORD, VALUES)
        counts = np.diff(w.first)
        grams = gram_sums(w.hashes, sorted({GRAM, WINDOW, *(int(c) for c in counts if 0 < c < WINDOW)}))
        at = np.arange(len(w.hashes))
        left = w.row_end - at
        n = np.repeat(counts, counts)
        k = at[(n >= WINDOW) & (left >= GRAM)]
        self.grams = np.unique(grams[GRAM][k]) if len(k) else np.zeros(0, np.uint64)
        self.gram_table = _table(self.grams)
        owner = np.repeat(np.arange(len(ids)), counts)
        self.ids, self.words, self.lengths = ids, w, {}
        for size in sorted(grams):
            own = at[(n >= WINDOW) & (left >= size)] if size == WINDOW else at[(n == size) & (left == size)]
            if size != WINDOW and (size > WINDOW or not len(own)):
                continue
            keys, inv = np.unique(grams[size][own], return_inverse=True) if len(own) else (np.zeros(0, np.uint64), own)
            held = np.unique(np.stack([inv, owner[own]], 1), axis=0) if len(own) else np.zeros((0, 2), np.int64)
            sample = np.zeros(len(keys), np.int64)
            sample[inv] = own
            self.lengths[size] = (keys, _table(keys), sample, held[:, 1],
                                  np.searchsorted(held[:, 0], np.arange(len(keys) + 1)))

    def window(self, at: int, size: int) -> list[bytes]:
        return spelled(self.data, self.words, at, size)


def spelled(data: np.ndarray, w: Words, at: int, size: int) -> list[bytes]:
    return [data[a:b].tobytes().lower() for a, b in zip(w.starts[at:at + size], w.ends[at:at + size])]


def find(index: Index, data: np.ndarray, off: np.ndarray) -> tuple[Words, list[tuple[int, int, int, int]]]:
    """The words of a block of documents, and (row, first word, size, window) of each occurrence."""
    w = words(data, off, IS_WORD, VALUES)
    n, h = len(w.hashes), w.hashes
    short = [s for s in index.lengths if s < WINDOW]
    grams = gram_sums(h, sorted({GRAM, *short}))
    end = w.row_end
    row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    found = []

    def check(at: np.ndarray, values: np.ndarray, size: int) -> None:
        keys, table, sample, _, _ = index.lengths[size]
        hit = _member(values, keys, table)
        for p, k in zip(at[hit].tolist(), np.searchsorted(keys, values[hit]).tolist()):
            if spelled(data, w, p, size) == index.window(int(sample[k]), size):
                found.append((int(row[p]), p, size, k))

    if len(index.grams) and n >= WINDOW:
        g, span = grams[GRAM], WINDOW - GRAM + 1
        least = g[:n - WINDOW + 1].copy()
        for j in range(1, span):
            np.minimum(least, g[j:j + len(least)], out=least)
        whole = end[:len(least)] >= np.arange(len(least)) + WINDOW
        kept = np.zeros(len(g), bool)
        for j in range(span):
            kept[j:j + len(least)] |= whole & (g[j:j + len(least)] == least)
        kept = np.flatnonzero(kept)
        met = kept[_member(g[kept], index.grams, index.gram_table)]
        if len(met):  # extend: all windows that hold a meeting
            at = np.unique((met[:, None] - np.arange(span)[None, :]).ravel())
            at = at[(at >= 0) & (at <= n - WINDOW)]
            at = at[end[at] >= at + WINDOW]
            if len(at):
                long = gram_sums(h[(at[:, None] + np.arange(WINDOW)[None, :])].ravel(), [WINDOW])[WINDOW]
                check(at, long[::WINDOW], WINDOW)
    for size in short:
        at = np.flatnonzero(end[:len(grams[size])] >= np.arange(len(grams[size])) + size)
        check(at, grams[size][at], size)
    return w, found


def summarise(index: Index, w: Words, found: list, n_rows: int) -> list[tuple[int, list, list, list]]:
    """Per row: words, starts and ends of the hit runs (word positions in the row), ids of the items."""
    per: dict[int, tuple[list, set]] = {}
    for r, p, size, k in found:
        spans, items = per.setdefault(r, ([], set()))
        spans.append((p - int(w.first[r]), p - int(w.first[r]) + size))
        _, _, _, holders, cut = index.lengths[size]
        items.update(index.ids[i] for i in holders[cut[k]:cut[k + 1]])
    out, counts = [], np.diff(w.first).tolist()
    for r in range(n_rows):
        spans, items = per.get(r, ((), ()))
        starts, ends = joined(spans)
        out.append((counts[r], starts, ends, sorted(items, key=lambda i: (i is None, i or ""))))
    return out


def joined(spans) -> tuple[list[int], list[int]]:
    """Disjoint runs that cover the same positions."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


_indexes: dict[str, Index] = {}


def _scan(docs: DataFrame, text_col: str, carry: list[str], items: list[tuple[str | None, str]], name: str) -> DataFrame:
    """``carry`` columns and a struct ``name`` (FOUND) per document, for one block of items."""
    key = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(items)
    schema = T.StructType([docs.schema[c] for c in carry] + [T.StructField(name, FOUND)])
    arrow = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                       ("items", pa.list_(pa.string()))])

    extra = [] if text_col in carry else [text_col]  # a text that is carried anyway goes to Python once
    at = len(carry) if extra else carry.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _indexes:
            _indexes.clear()
            _indexes[key] = Index([i for i, _ in shared.value], [t for _, t in shared.value])
        index = _indexes[key]
        for b in batches:
            off, data = utf8(b.column(at))
            out = []
            for lo, hi in blocks(off):
                w, found = find(index, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                out += summarise(index, w, found, hi - lo)
            cols = list(zip(*out)) if out else [[], [], [], []]
            found = pa.StructArray.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)],
                                               fields=list(arrow))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(carry)], found], names=[*carry, name])

    return docs.select(*carry, *extra).mapInArrow(run, schema)


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", carry: list[str] | None = None,
         name: str = "found", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document's ``carry`` columns and a struct ``name``: n_words, the runs of hit words
    (starts, ends: word positions) and the ids of the items that have a window in it."""
    carry = list(docs.columns) if carry is None else carry
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")) \
                     .filter("t is not null")
    total = items.agg(F.sum(F.octet_length("t") + F.coalesce(F.length("i"), F.lit(0)))).first()[0] or 0
    n = -(-total // block_bytes)
    if n <= 1:
        return _scan(docs, text_col, carry, [tuple(r) for r in items.collect()], name)
    cut = items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.struct(F.monotonically_increasing_id().alias("m"), F.xxhash64(text_col).alias("h")))
    keyed = staged(keyed)
    each = None
    for block in range(n):
        part = _scan(keyed, text_col, [key], [tuple(r) for r in cut.filter(F.col("b") == block).drop("b").collect()], name)
        each = part if each is None else each.unionByName(part)
    merged = F.udf(lambda a, b: joined(zip(sum(a, []), sum(b, []))), "starts array<bigint>, ends array<bigint>")
    one = each.groupBy(key).agg(F.max(f"{name}.n_words").alias("n"), F.collect_list(f"{name}.starts").alias("a"),
                                F.collect_list(f"{name}.ends").alias("b"),
                                F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{name}.items")))).alias("i"))
    one = one.withColumn("s", merged("a", "b")).select(
        key, F.struct(F.col("n").alias("n_words"), "s.starts", "s.ends", F.col("i").alias("items")).alias(name))
    return keyed.select(key, *carry).join(one, key).drop(key)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its words, hit words, the items found, and whether it is contaminated."""
    m = mark(docs, benchmark, text_col, [id_col], free_name(docs, "found"))
    f = m.columns[-1]
    hit = F.aggregate(F.zip_with(f"{f}.starts", f"{f}.ends", lambda a, b: b - a), F.lit(0).cast("bigint"),
                      lambda a, x: a + x)
    return m.select(id_col, F.col(f"{f}.n_words").alias("n_words"), hit.alias("n_hit"),
                    F.size(f"{f}.items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join(f"{f}.items", ","), 256).alias("items_sha256"),
                    (hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents without a hit word, all columns as they were."""
    name = free_name(docs, "found")
    return mark(docs, benchmark, text_col, None, name).filter(F.size(f"{name}.starts") == 0).drop(name)
