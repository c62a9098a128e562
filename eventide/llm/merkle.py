"""Merkle manifest of a dataset, its tree stored in van Emde Boas layout.

Rows are leaves.  Per group, leaves in order are hashed by runs of ``ARITY``
(the last run may hold fewer, even one) until one node remains, the group's
subroot; the subroots in the groups' order give the root in the same way.  A
node is the SHA-256 of its children's digests as hex text.

The tree is cut into aligned subtrees of at most ``LEVELS`` levels (512 leaves).
Such a block is one binary value, its nodes laid out recursively: a tree of h
levels is its top h // 2 levels followed by the subtrees below them, each laid
out in the same way (van Emde Boas).  ``addresses`` gives a node's place by
arithmetic alone, for building and for the lookup of siblings.  The blocks'
roots are the leaves of the next tier, and so on, so a task holds one block
at a time and a table of n rows takes log n / log 512 tiers.

Leaves are put in order by range partitioning (a hot group is cut into many
ranges) and reach the block builder with their digests alone, never their texts.
A block's path to the root is joined to it once, tier by tier from the top.

Defined cases: rows that tie in the order (repeated rows, equal or null ids) are
ordered by their digests, so equal rows have equal digests and a leaf each; a
null group comes first; a lone leaf is its group's subroot and a lone subroot the
root; an empty table has no root (null) and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scan import global_rank, running
from .staging import staged

ARITY, LEVELS = 8, 4
BLOCK = ARITY ** (LEVELS - 1)


@cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Per level from the root down, the place of each of its nodes in the layout of a full tree."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    upper, lower = addresses(top), addresses(levels - top)
    roots = ARITY ** top  # of the subtrees below
    first = nodes(top) + np.arange(roots) * nodes(levels - top)
    return (*upper, *((first[:, None] + a[None, :]).ravel() for a in lower))


def nodes(levels: int) -> int:
    """Nodes of a full tree."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def depth(leaves: int) -> int:
    """Levels of the lowest tree that holds so many leaves."""
    levels = 1
    while ARITY ** (levels - 1) < leaves:
        levels += 1
    return levels


def counts(leaves: int, levels: int) -> list[int]:
    """Nodes on each level, from the root down."""
    out = [leaves]
    for _ in range(levels - 1):
        out.append(-(-out[-1] // ARITY))
    return out[::-1]


class Block:
    """An aligned subtree: its nodes' digests in the layout, and how many leaves it has."""

    def __init__(self, stored: bytes, leaves: int, levels: int):
        self.stored = np.frombuffer(stored, np.uint8).reshape(-1, 32)
        self.leaves, self.levels = leaves, levels
        self.counts = counts(leaves, levels)

    @classmethod
    def build(cls, leaves: np.ndarray, levels: int) -> Block:
        """From leaf digests (rows of 32 bytes) up."""
        at = addresses(levels)
        stored = np.zeros((nodes(levels), 32), np.uint8)
        level = leaves
        for d in range(levels - 1, -1, -1):
            stored[at[d][:len(level)]] = level
            if d:
                text, run = level.tobytes().hex().encode(), 64 * ARITY
                level = np.frombuffer(b"".join([hashlib.sha256(text[i:i + run]).digest()
                                                for i in range(0, len(text), run)]), np.uint8).reshape(-1, 32)
        return cls(stored.tobytes(), len(leaves), levels)

    def level(self, d: int) -> bytes:
        """Hex text of the digests on a level, left to right."""
        return self.stored[addresses(self.levels)[d][:self.counts[d]]].tobytes().hex().encode()

    @property
    def root(self) -> bytes:
        return self.stored[0].tobytes()

    def paths(self) -> Iterator[list[tuple[bytes, bytes]]]:
        """Per leaf, from its level up: the hex text of the siblings left and right of the node above it."""
        texts = [self.level(d) for d in range(self.levels)]
        for leaf in range(self.leaves):
            out, i = [], leaf
            for d in range(self.levels - 1, 0, -1):
                lo = i // ARITY * ARITY
                text = texts[d]
                out.append((text[64 * lo:64 * i], text[64 * (i + 1):64 * (lo + ARITY)]))
                i //= ARITY
            yield out


def pack(path: list[tuple[bytes, bytes]]) -> bytes:
    """Two lengths and the digests of each level."""
    return b"".join([bytes((len(a) // 64, len(b) // 64)) + bytes.fromhex((a + b).decode()) for a, b in path])


def unpack(packed: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(packed):
        a, b = packed[at:at + 2]
        text = packed[at + 2:at + 2 + 32 * (a + b)].hex().encode()
        out.append((text[:64 * a], text[64 * a:]))
        at += 2 + 32 * (a + b)
    return out


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf's hex text and the siblings on its way up give, as hex text."""
    for a, b in path:
        leaf = hashlib.sha256(a + leaf + b).hexdigest().encode()
    return leaf


def field(c: Column) -> Column:
    """A value as its byte count, a colon and itself; a null as a hyphen."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Digest of a row's values."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def _digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


_PLACED = "g string, pos bigint, n bigint, d binary"


def _build(placed: DataFrame, payload: list[str]) -> DataFrame:
    """Blocks (g, block, n, leaves, stored, root and the payload as lists) from leaves (g, pos, n, d, payload);
    n is the number of leaves of the group on this tier."""
    kinds = [T.StructField(c, T.ArrayType(placed.schema[c].dataType)) for c in payload]
    schema = T.StructType([T.StructField("g", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("leaves", T.IntegerType()), T.StructField("stored", T.BinaryType()),
                           T.StructField("root", T.BinaryType()), *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows of the block that the next batch may go on with

        def blocks(t: pa.Table, last: bool) -> tuple[list[pa.Table], pa.Table | None]:
            starts = np.flatnonzero(t.column("pos").to_numpy() % BLOCK == 0).tolist()
            cut = [*starts, t.num_rows]
            parts = [t.slice(a, b - a) for a, b in zip(cut, cut[1:])]
            return (parts, None) if last or not parts else (parts[:-1], parts[-1])

        def stored(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(parts), 64):
                got = []
                for t in parts[lo:lo + 64]:
                    n = t.column("n")[0].as_py()
                    got.append((t, n, Block.build(_digests(t.column("d")), LEVELS if n > BLOCK else depth(n))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t.column("g")[0].as_py() for t, _, _ in got], pa.string()),
                     pa.array([t.column("pos")[0].as_py() // BLOCK for t, _, _ in got], pa.int64()),
                     pa.array([n for _, n, _ in got], pa.int64()), pa.array([b.leaves for _, _, b in got], pa.int32()),
                     pa.array([b.stored.tobytes() for _, _, b in got], pa.binary()),
                     pa.array([b.root for _, _, b in got], pa.binary()),
                     *[pa.array([t.column(c).to_pylist() for t, _, _ in got], pa.list_(t.schema.field(c).type)) for c in payload]],
                    names=schema.fieldNames())

        for b in batches:
            t = pa.Table.from_batches([b])
            parts, held = blocks(t if held is None else pa.concat_tables([held, t]), False)
            yield from stored(parts)
        if held is not None:
            yield from stored(blocks(held, True)[0])

    rows = placed.select("g", "pos", "n", "d", *payload).withColumn("block", F.expr(f"pos div {BLOCK}"))
    return rows.repartition("g", "block").sortWithinPartitions("g", "pos").drop("block").mapInArrow(run, schema)


def _tiers(placed: DataFrame, most: int, payload: list[str]) -> list[DataFrame]:
    """The blocks of each tier from the leaves up; ``most`` is the largest group's number of leaves."""
    out = [staged(_build(placed, payload))]
    while most > BLOCK:
        most = -(-most // BLOCK)
        up = out[-1].filter(f"n > {BLOCK}").select("g", F.col("block").alias("pos"),
                                                   F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("root").alias("d"))
        out.append(staged(_build(up, [])))
    return out


def _tops(tiers: list[DataFrame]) -> DataFrame:
    """(g, d): the root of each group."""
    out = None
    for t in tiers:
        part = t.filter(f"n <= {BLOCK}").select("g", F.col("root").alias("d"))
        out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Manifest:
    """Blocks of the groups' trees and of the tree over them, tier by tier, and the root's hex text."""

    groups: list[DataFrame]
    over: list[DataFrame]
    root: str | None
    key: str


def manifest(leaves: DataFrame, group: str, order: str, digest: str = "d", carry: tuple[str, ...] = ()) -> Manifest:
    """Build the trees from rows with a group (string), an order column and a digest (binary).  ``carry`` columns,
    narrow ones, are kept with the leaves for ``proofs``."""
    names = {c: f"c{i}" for i, c in enumerate((order, *carry))}
    # a group's key: nulls first, then by the value's bytes
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    # digests are written once, so that finding the ranges below doesn't read and hash the texts again
    rows = staged(leaves.select(key.alias("g"), F.col(digest).alias("d"), *[F.col(c).alias(n) for c, n in names.items()]))
    # c0 is the order column; null ids come first
    placed = running(rows, "g", ["c0", "d", *[n for n in names.values() if n != "c0"]], {"pos": ("count", "d")})
    placed = staged(placed.withColumn("pos", F.col("pos") - 1))
    sizes = staged(placed.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    most = sizes.agg(F.max("n")).first()[0]
    groups = _tiers(placed.join(sizes, "g"), most or 0, list(names.values()))
    tops = global_rank(_tops(groups), "g", "pos")
    n = tops.count()
    over = _tiers(tops.select(F.lit("").alias("g"), "pos", F.lit(n).cast("bigint").alias("n"), "d", F.col("g").alias("of")), n, ["of"])
    root = _tops(over).first()
    return Manifest(groups, over, root and bytes(root["d"]).hex(), order)


def _expanded(blocks: DataFrame, above: DataFrame, of_groups: bool) -> DataFrame:
    """(g, pos, path, subroot) of each leaf of the blocks: its packed way to the root.  ``of_groups``: the leaves
    are subroots, and g and subroot their group and digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                block = Block(r["stored"], r["leaves"], LEVELS if r["n"] > BLOCK else depth(r["n"]))
                paths = [pack(p) + r["path"] for p in block.paths()]
                base = r["block"] * BLOCK
                last = block.level(block.levels - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["of"] if of_groups else [r["g"]] * len(paths), pa.string()),
                     pa.array([0] * len(paths) if of_groups else range(base, base + len(paths)), pa.int64()), pa.array(paths, pa.binary()),
                     pa.array([last[64 * i:64 * i + 64].decode() for i in range(len(paths))] if of_groups
                              else [r["subroot"]] * len(paths), pa.string())],
                    names=["g", "block", "path", "subroot"])

    cols = ["g", "block", "n", "leaves", "stored", *(["of"] if of_groups else [])]
    return blocks.select(*cols).join(above, ["g", "block"]).mapInArrow(run, "g string, block bigint, path binary, subroot string")


def _paths(m: Manifest) -> DataFrame:
    """(g, block, path, subroot) of each block on the lowest tier of the groups' trees."""
    spark = m.groups[0].sparkSession
    above = spark.createDataFrame([("", 0, b"", "")], "g string, block bigint, path binary, subroot string")
    for t in reversed(m.over[1:]):
        above = staged(_expanded(t, above, False))
    tops = staged(_expanded(m.over[0], above, True))
    above = None
    for t in reversed(m.groups):
        ends = t.filter(f"n <= {BLOCK}").select("g").join(tops, "g").select("g", "block", "path", "subroot")
        here = ends if above is None else above.unionByName(ends)
        if t is m.groups[0]:
            return here
        above = staged(_expanded(t, here, False))


def proofs(m: Manifest, claim: str | None = None, digest: bool = False) -> DataFrame:
    """Per leaf: the order column and the carried ones (as c0, c1, ...), leaf, subroot, root, the proof (hex digests of
    the siblings, level by level, left to right; with ``digest`` the SHA-256 of their concatenation), the root
    recomputed from the proof and the leaf (or the digest in column ``claim``, where it isn't null), and
    whether it is the root."""
    carried = [f for f in m.groups[0].schema if f.name[0] == "c" and f.name[1:].isdigit()]
    names = [f.name for f in carried]
    proof = T.StringType() if digest else T.ArrayType(T.StringType())
    schema = T.StructType([*(T.StructField(f.name, f.dataType.elementType) for f in carried),
                           *(T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root")),
                           T.StructField("proof", proof), T.StructField("folded_root", T.StringType())])
    root = m.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in ("leaves", "n", "stored", "path", "subroot")}
                payload = [b.column(c)[i].values for c in names]
                block = Block(r["stored"], r["leaves"], LEVELS if r["n"] > BLOCK else depth(r["n"]))
                text = block.level(block.levels - 1)
                own = [text[64 * j:64 * j + 64] for j in range(block.leaves)]
                claims = [None] * len(own) if claim is None else b.column(claim)[i].values.to_pylist()
                above = unpack(r["path"])
                tail = b"".join([x + y for x, y in above])
                sides, folded = [], []
                for mine, path, c in zip(own, block.paths(), claims):
                    joined = b"".join([x + y for x, y in path]) + tail
                    sides.append(hashlib.sha256(joined).hexdigest() if digest
                                 else [joined[k:k + 64].decode() for k in range(0, len(joined), 64)])
                    folded.append(fold(fold(mine if c is None else c.hex().encode(), path), above).decode())
                yield pa.RecordBatch.from_arrays(
                    [*payload, pa.array([x.decode() for x in own], pa.string()), pa.array([r["subroot"]] * len(own), pa.string()),
                     pa.array([root] * len(own), pa.string()),
                     pa.array(sides, pa.string() if digest else pa.list_(pa.string())), pa.array(folded, pa.string())],
                    names=schema.fieldNames())

    cols = ["g", "block", "n", "leaves", "stored", *names]
    out = m.groups[0].select(*cols).join(_paths(m), ["g", "block"]).mapInArrow(run, schema)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of a manifest of documents grouped by lang;
    the rows whose id's crc32 is divisible by 3 are verified with the capitals A-Z of their texts lowered."""
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select("doc_id", "lang", leaf(*head, F.col("text")).alias("d"),
                       F.when(changed, leaf(*head, F.translate("text", _UPPER, _LOWER))).alias("claim"))
    m = manifest(rows, "lang", "doc_id", carry=("claim",))
    return proofs(m, claim="c1", digest=True).select(
        F.col("c0").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", "verified")
