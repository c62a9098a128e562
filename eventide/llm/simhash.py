"""SimHash near-duplicate classes with pigeonring filtering.

``fingerprints``: words are runs of bytes other than space and 0x09-0x0D after
lower-casing A-Z; shingles of ``shingle`` words, repeats included, joined by
one space (fewer words: one shingle of all; none: fingerprint zero); a bit is
1 if set in over half of the shingles' XXH64 (seed 42).

``components``: fingerprints at Hamming distance of at most ``max_bits`` are
linked; a class is a connected component, named by its smallest id.

Candidates come from the pigeonring principle (Qin and Xiao, 2018).  The 64
bits are cut into m = max_bits + 1 segments on a ring.  If two fingerprints
differ in at most t bits, there is a segment from which every chain of l
consecutive segments differs in at most floor(l * t / m) bits.  For l = 1 the
budget is 0, which gives an equi-join on the segment; the longer chains prune
inside that join, before the full distance is looked at.

A segment value that over ``bucket`` different fingerprints share would cost a
quadratic number of comparisons.  Such buckets take an exact linear way:
two values differ in at most two bits just when some value is within one bit
of both, so each of their fingerprints is laid on its 65 neighbours and those
that meet (at most 65) are linked in a star.

Defined cases: a null text counts as empty; fingerprint zero links like any
other; repeated rows give repeated result rows; a null id never names a class
unless all ids of the class are null (then the class id is null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graphs import connected_components
from .arrays import utf8
from .staging import free_name, staged

SHINGLE, MAX_BITS, SEED = 3, 2, 42
_PART = 1 << 16  # shingles whose bits are held at once


def simhash(raw: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text."""
    from xxhash import xxh64_digest

    tokens = raw.lower().split()  # bytes: lowers A-Z only, splits at space and 0x09-0x0D
    if not tokens:
        return 0
    text = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[min(shingle, len(tokens)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, _PART):
        part = zip(starts[lo:lo + _PART], ends[lo:lo + _PART])
        digests = b"".join([xxh64_digest(text[a:b], SEED) for a, b in part])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): one row per document, the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, data = utf8(b.column(1))
            fps = np.fromiter((simhash(data[off[i]:off[i + 1]].tobytes(), shingle) for i in range(b.num_rows)),
                              np.uint64, b.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=[id_col, "fp"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _segments(m: int) -> list[tuple[int, int]]:
    """(shift, width) of m segments of 64 bits, widths as equal as can be."""
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND((1 << width) - 1) if width < 64 else fp


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = 64) -> DataFrame:
    """Edges (a, b) whose connected components are those of all links of ``fps`` (distinct column fp).

    An edge may end in a value that is no fingerprint: one within one bit of
    two of them (see the module's text).
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    m = max_bits + 1
    parts = _segments(m)
    seg = fps.select("fp", F.posexplode(F.array(*[_segment(F.col("fp"), *p) for p in parts])).alias("seg", "val"))
    size = seg.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("n"))
    shared = size.filter("n > 1")
    sized = staged(seg.join(shared, ["seg", "val"]))
    light = sized.filter(F.col("n") <= bucket).drop("n")
    a, b = light.alias("a"), light.alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    near = F.col("a.fp") < F.col("b.fp")
    for first in range(m):  # chains from the shared segment on, each within its budget
        for length in range(2, m + 1):
            chain = sum((F.bit_count(_segment(x, *parts[(first + i) % m])) for i in range(1, length)),
                        F.lit(0))
            near &= (F.col("a.seg") != first) | (chain <= length * max_bits // m)
    pairs = a.join(b, (F.col("a.seg") == F.col("b.seg")) & (F.col("a.val") == F.col("b.val")) & near) \
             .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    heavy = sized.filter(F.col("n") > bucket).select("fp").distinct()
    around = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    met = (heavy.select("fp", F.explode(around).alias("z")).groupBy("z")
                .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1))
    if max_bits == 2:
        stars = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    else:  # only a value that is itself a fingerprint is within one bit of its neighbours
        stars = met.filter(F.array_contains("fps", F.col("z"))) \
                   .select(F.col("z").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return pairs.unionByName(stars).distinct() if max_bits else pairs


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS, bucket: int = 64) -> DataFrame:
    """(id, fp, component_id): one row per document; component_id is the smallest id of its class."""
    marked = staged(fingerprints(docs, id_col, text_col, shingle))
    least = staged(marked.groupBy("fp").agg(F.min(id_col).alias("least")))
    edges = links(least.select("fp"), max_bits, bucket)
    comp = connected_components(edges, "a", "b", node="fp")
    named = least.join(comp, "fp")
    of = named.groupBy("component").agg(F.min("least").alias("component_id"))
    multi = named.join(of, "component").select("fp", "component_id")
    single = least.join(multi.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    return marked.join(multi.unionByName(single), "fp").select(id_col, "fp", "component_id")


def hex16(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, all columns as they were: the first by id (null last), then by the text's hash."""
    row, key = free_name(docs, "row_key"), free_name(docs, "kept_row")
    # written with the rows, so that the rows chosen are those returned
    keyed = staged(docs.withColumn(row, F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"),
        F.monotonically_increasing_id().alias("m"))))
    found = components(keyed, row, text_col, **options)
    keep = found.filter(F.col(f"{row}.m") == F.col("component_id.m")).select(F.col(f"{row}.m").alias(key))
    return keyed.join(keep, F.col(f"{row}.m") == F.col(key), "left_semi").drop(row)
