"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are words.  ``plans`` gives each source its target (its share by weight
of all words; no more than ``CAP`` times its own, the excess reshared by weight) and
turns it into an exact quota of blocks.  A source's documents stand on a line
in hash order, cut into blocks of ``BLOCK_WORDS`` words (the last may be shorter).
A source whose quota exceeds its line takes the line whole, once per epoch, and the
rest from a last epoch, whose last block is cut so that the quota is met to
the word.

The quotas are dealt to the output shards by a tree: a node with a vector of
block counts and a run of shards draws its left half's vector from the
multivariate hypergeometric distribution and leaves the rest to the right, down
to single shards.  So each shard has an exact count of blocks of each source, as
if all blocks had been shuffled together.  Sources are taken by chunks of
``CHUNK``: chunks are split first, then the sources within each, against the
shard sizes that the chunk was given; a task holds one chunk.

A source's draws are numbered; consecutive numbers belong to the shards in
order, so shards draw disjoint blocks.  Draw number and block are tied by a keyed
permutation per source and epoch (a Feistel network on the block's number), so
no list of blocks is ever built.  Each draw has a pseudo-random place, by which
its shard is shuffled.

Every random choice depends on ``seed`` and on the rows alone, so reruns agree.

Defined cases: a null text has no words; a source without words has target 0; a
null source is one source, the last in order; rows of one id are documents
of their own; rows alike in id, size and text are interchangeable; an empty
table gives no rows.  numpy draws exact hypergeometric numbers of populations
below 10**9 blocks; beyond, a rounded normal with the same mean and variance
takes its place (counts stay exact, their spread is approximate).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scan import global_prefix_sum, global_rank, running
from .arrays import blocks, mix, utf8
from .staging import staged

WEIGHTS, CAP = (5, 2, 1), 3
BLOCK_WORDS, SHARDS, CHUNK, SEED = 256, 64, 4096, 11
_EXACT = 10**9

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Words (runs of bytes other than space and 0x09-0x0D) of each row of a block."""
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    heads = off[:-1][off[:-1] < len(data)]
    start[heads] = word[heads]
    return np.diff(np.concatenate(([0], np.cumsum(start)))[off])


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(id, source, h, size), written: h is the text's hash."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("source", T.StringType()),
                           T.StructField("h", T.LongType()), T.StructField("size", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, data = utf8(b.column(0))
            n = [word_counts(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]) for lo, hi in blocks(off)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(np.concatenate(n) if n else [], pa.int64())], names=schema.fieldNames())

    return staged(docs.select(F.col(text_col), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                              F.xxhash64(text_col).alias("h")).mapInArrow(run, schema))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(g, size, rank, weight, target) of the sources (g, size); g orders them and the weights repeat in this order.

    Shares by weight that no source passes ``cap`` times its size with are min(cap * size, x * weight) for one
    x.  In the order of cap * size / weight the sources up to some place are at their cap; x follows
    from the sums up to there."""
    ranked = global_rank(sizes, "g", "rank")
    table = F.array(*[F.lit(w) for w in weights])
    at = ranked.withColumn("weight", F.element_at(table, (F.col("rank") % len(weights) + 1).cast("int")).cast("bigint")) \
               .withColumn("most", F.col("size") * cap).withColumn("ratio", F.col("most") / F.col("weight"))
    order = ["ratio", "rank"]
    summed = global_prefix_sum(at, order, "most", "capped")
    summed = staged(global_prefix_sum(summed, order, "weight", "passed"))
    total, all_weights = summed.agg(F.sum("size"), F.sum("weight")).first()
    x = (F.lit(total or 0) - F.col("capped")) / (F.lit(all_weights or 0) - F.col("passed"))
    found = summed.withColumn("x", x).filter("ratio >= x").agg(F.min_by("x", F.struct(*order))).first()[0] or 0.0
    target = F.least(F.col("most").cast("double"), F.lit(found) * F.col("weight"))
    return summed.select("g", "size", "rank", "weight", target.alias("target"))


# ---- the splitting tree ----

def _draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Hypergeometric: how many of n taken from good + bad are good."""
    if good + bad < _EXACT:
        return int(rng.hypergeometric(good, bad, n)) if n and good else 0
    total = good + bad
    mean = n * (good / total)
    spread = math.sqrt(max(0.0, mean * (bad / total) * ((total - n) / max(1, total - 1))))
    return min(max(round(mean + spread * rng.standard_normal()), n - bad, 0), good, n)


def drawn(rng: np.random.Generator, counts: list[int], n: int) -> list[int]:
    """n taken without replacement from a population with the given counts."""
    out, rest = [], sum(counts)
    for c in counts:
        rest -= c
        out.append(_draw(rng, c, rest, n))
        n -= out[-1]
    return out


def split(counts: list[int], sizes: list[int], seed: tuple[int, ...], node: int = 1) -> list[list[int]]:
    """Per shard (of the given sizes, which sum up to the counts) its count of each source."""
    if len(sizes) == 1:
        return [counts]
    half = len(sizes) // 2
    left = drawn(np.random.Generator(np.random.PCG64([*seed, node])), counts, sum(sizes[:half]))
    right = [c - x for c, x in zip(counts, left)]
    return split(left, sizes[:half], seed, 2 * node) + split(right, sizes[half:], seed, 2 * node + 1)


# ---- blocks ----

def permuted(x: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A permutation of [0, size) per key: a four-round Feistel network on the next even number of bits,
    walked until it falls below the size."""
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    bits += (np.uint64(1) << (bits * np.uint64(2))) < size.astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            b, m, k = bits[todo], mask[todo], key[todo]
            left, right = out[todo] >> b, out[todo] & m
            for turn in range(4):
                left, right = right, left ^ (mix(right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64))) & m)
            out[todo] = left << b | right
            todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _keys(g: list[str], seed: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(s.encode(), seed) for s in g], np.uint64)


def _epoch_key(key: np.ndarray, epoch: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(key + np.uint64(1) + np.asarray(epoch).astype(np.uint64))


def quota(size: int, target: float, key: int, block: int, cap: int) -> tuple[int, int, int, int]:
    """(blocks of the line, whole epochs, blocks of the last epoch, words that its last block leaves out)."""
    if not size:
        return 0, 0, 0, 0
    words = min(math.floor(target + 0.5), cap * size)
    n = -(-size // block)
    epochs, rest = divmod(words, size)
    if not rest:
        return n, epochs, 0, 0
    short = block - (size - (n - 1) * block)  # what the last block of the line lacks
    at = int(permuted(np.array([n - 1]), np.array([n]), _epoch_key(np.array([key], np.uint64), epochs))[0])
    c = -(-rest // block)
    if c > at:
        c = -(-(rest + short) // block)
    return n, epochs, c, c * block - (short if c > at else 0) - rest


_PLAN = "g string, size bigint, target double, key bigint, n bigint, epochs int, last bigint, over bigint, chunk bigint, draws bigint"


def plans(of: DataFrame, shards: int = SHARDS, block: int = BLOCK_WORDS, seed: int = SEED, cap: int = CAP, chunk: int = CHUNK) -> DataFrame:
    """Per source of ``targets`` its quota, and ``ends``: per shard the number after the last draw that it gets."""
    def quotas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = b.column("g").to_pylist()
            keys = _keys(g, seed)
            got = [quota(s, t, int(k), block, cap) for s, t, k in zip(b.column("size").to_pylist(), b.column("target").to_pylist(), keys)]
            n, epochs, last, over = ([x[i] for x in got] for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [b.column("g"), b.column("size"), b.column("target"), pa.array(keys.view(np.int64)), pa.array(n, pa.int64()),
                 pa.array(epochs, pa.int32()), pa.array(last, pa.int64()), pa.array(over, pa.int64()),
                 pa.array([r // chunk for r in b.column("rank").to_pylist()], pa.int64()),
                 pa.array([a * e + c for a, e, c in zip(n, epochs, last)], pa.int64())],
                names=["g", "size", "target", "key", "n", "epochs", "last", "over", "chunk", "draws"])

    each = staged(of.select("g", "size", "target", "rank").mapInArrow(quotas, _PLAN))
    sums = sorted(each.groupBy("chunk").agg(F.sum("draws").alias("d")).collect())  # a number for each chunk of sources
    total = sum(r["d"] for r in sums)
    sizes = [total * (k + 1) // shards - total * k // shards for k in range(shards)]
    shares = split([r["d"] for r in sums], sizes, (seed,)) if sums else []
    mine = {r["chunk"]: [s[i] for s in shares] for i, r in enumerate(sums)}

    def tree(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("g")
        c = int(part["chunk"].iloc[0])
        got = np.array(split(part["draws"].tolist(), mine[c], (seed, c + 1)), np.int64)
        return part.assign(ends=list(np.cumsum(got, axis=0).T))

    return staged(each.groupBy("chunk").applyInPandas(tree, _PLAN + ", ends array<bigint>"))


PIECES = T.ArrayType(T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("place", T.LongType()),
                                   T.StructField("epoch", T.IntegerType()), T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType())]))


def _cut(start: np.ndarray, size: np.ndarray, plan: dict[str, np.ndarray], ends: list[np.ndarray], block: int) -> tuple[np.ndarray, ...]:
    """(row, shard, place, epoch, start, end) of the drawn pieces of documents that stand on their source's line at
    ``start``, given row by row the plan of their source; start and end count the document's words."""
    first = start // block
    number = np.where(size > 0, (start + size - 1) // block - first + 1, 0)
    row = np.repeat(np.arange(len(size)), number)
    b = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + first[row]
    lo, hi = np.maximum(start[row], b * block), np.minimum((start + size)[row], (b + 1) * block)
    line_end = np.minimum((b + 1) * block, plan["size"][row])
    out: list[tuple[np.ndarray, ...]] = []
    for e in range(int(plan["epochs"].max(initial=-1)) + 1 + bool(len(size))):
        here = np.flatnonzero((plan["epochs"][row] > e) | ((plan["epochs"][row] == e) & (plan["last"][row] > 0)))
        if not len(here):
            continue
        r = row[here]
        at = permuted(b[here], plan["n"][r], _epoch_key(plan["key"].view(np.uint64)[r], e))
        end = hi[here]
        final = plan["epochs"][r] == e
        end = np.where(final & (at == plan["last"][r] - 1), np.minimum(end, line_end[here] - plan["over"][r]), end)
        ok = (~final | (at < plan["last"][r])) & (end > lo[here])
        draw = e * plan["n"][r] + at
        out.append((r[ok], draw[ok], np.full(int(ok.sum()), e, np.int32), (lo[here] - start[r])[ok], (end - start[r])[ok]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.int32), z, z.astype(np.int32), z, z
    r, draw, epoch, a, z = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((a, epoch, r))
    r, draw, epoch, a, z = (x[order] for x in (r, draw, epoch, a, z))
    shard = np.fromiter((np.searchsorted(ends[i], d, side="right") for i, d in zip(r.tolist(), draw.tolist())), np.int32, len(r))
    with np.errstate(over="ignore"):
        place = mix(mix(plan["key"].view(np.uint64)[r]) + draw.astype(np.uint64)).view(np.int64)
    return r, shard, place, epoch, a, z


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, shards: int = SHARDS, block: int = BLOCK_WORDS,
                seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """Per document: id, size, source_size, target (its source's) and ``pieces``, the runs of its words that
    the mix takes: shard, place (the shard's shuffled order), epoch, start and end in words."""
    # a source's key: nulls last, else by the value's bytes, which is the order of code points
    g = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source"))
    rows = staged(sized(docs, id_col, source_col, text_col).select("id", g.alias("g"), "h", "size"))
    of = plans(targets(staged(rows.groupBy("g").agg(F.sum("size").alias("size"))), weights, cap), shards, block, seed, cap, chunk)
    keyed = rows.withColumn("k", F.xxhash64(F.lit(seed), "id", "h"))
    lined = running(keyed, "g", ["k", "id", "h", "size"], {"start": ("sum", "size")}).withColumn("start", F.col("start") - F.col("size"))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("size", T.LongType()),
                           T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
                           T.StructField("pieces", PIECES)])
    numbers = ["size", "key", "n", "epochs", "last", "over"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = whole.column("size").to_numpy()
            weight = np.concatenate(([0], np.cumsum(sizes // block + 2)))  # at least its pieces an epoch
            for lo, hi in blocks(weight, 1 << 16):
                b = whole.slice(lo, hi - lo)
                plan = {c: b.column("p_" + c).to_numpy() for c in numbers}
                ends = b.column("ends")
                flat, cut = ends.flatten().to_numpy(), np.concatenate(([0], np.cumsum([len(x) for x in ends])))
                r, shard, place, epoch, a, z = _cut(b.column("start").to_numpy(), b.column("size").to_numpy(), plan,
                                                    [flat[x:y] for x, y in zip(cut, cut[1:])], block)
                at = np.searchsorted(r, np.arange(b.num_rows + 1)).astype(np.int32)
                got = pa.StructArray.from_arrays([pa.array(x) for x in (shard, place, epoch, a, z)], names=["shard", "place", "epoch", "start", "end"])
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("size"), b.column("p_size"), b.column("target"),
                                                  pa.ListArray.from_arrays(pa.array(at), got)], names=schema.fieldNames())

    return lined.select("id", "g", "size", "start") \
        .join(of.select("g", "target", "ends", *[F.col(c).alias("p_" + c) for c in numbers]), "g") \
        .select("id", "size", "start", "target", "ends", *["p_" + c for c in numbers]).mapInArrow(run, schema)


def shuffled(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix in order: (shard, place, epoch, id, start, end), sorted within its partitions; a shard is a run of
    partitions, and pieces of one block stay together."""
    return mixed.select(F.col(id_col), F.explode("pieces").alias("p")).select("p.shard", "p.place", "p.epoch", id_col, "p.start", "p.end") \
        .repartitionByRange("shard", "place").sortWithinPartitions("shard", "place", id_col, "start")


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document: id, size, source_size, target and ``taken``, the words of it that the mix takes, repeats counted."""
    mixed = mix_sources(docs, **options)
    taken = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda n, p: n + p["end"] - p["start"])
    return mixed.select(mixed.columns[0], "size", "source_size", "target", taken.alias("taken"))
