"""Exact top-k by inner product: ball trees per shard, searched by branch and bound.

Components become floor(scale * x); scores are integer inner products.  A
task turns every ``SHARD_ROWS`` rows of its partition into one shard: a binary
ball tree (median splits along the widest direction, leaves of ``LEAF`` rows)
with the centre and radius of every node.  No inner product of a query q with
a row below a node exceeds q.centre + |q| * radius.

Queries are taken in blocks of at most ``BLOCK`` (what is broadcast is bounded).
For each block, the shards are first probed: each query looks into the leaf of
the highest bound of each shard, and the k-th best score so found, over all
shards, is a score that the final k-th can't be below.  That score is shared
with every task of the search, where it prunes inner nodes from the root down;
leaves are visited in order of their bound, the k-th score rises with each
visit and is carried from shard to shard of a task, and a query stops at the
first leaf whose bound is below it.

Defined cases: vectors that are null, empty or hold a null or non-finite component take
no part; vectors are compared with those of their own length only; equal
(id, vector) rows count once; all rows with the query's id are its own; fewer
than k candidates give as many results; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .staging import staged

SCALE, K = 256, 5
SHARD_ROWS, LEAF, BLOCK, PART = 8192, 64, 16384, 1024


class Tree:
    """Rows in leaf order, nodes in breadth-first order: row range, children (-1: leaf), centre, radius."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        lo, hi, left, centre, radius = [0], [len(ids)], [], [], []
        node = 0
        while node < len(lo):
            a, b = lo[node], hi[node]
            rows = x[order[a:b]].astype(np.float64)
            c = rows.mean(axis=0)
            centre.append(c)
            radius.append(float(np.sqrt(((rows - c) ** 2).sum(axis=1).max())))
            if b - a > leaf and radius[-1] > 0:
                d = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(rows[:, d], mid)]
                left.append(len(lo))
                lo += [a, a + mid]
                hi += [a + mid, b]
            else:
                left.append(-1)
            node += 1
        self.ids, self.x = ids[order], x[order]
        self.lo, self.hi, self.left = np.array(lo), np.array(hi), np.array(left)
        self.centre, self.radius = np.array(centre), np.array(radius)

    def pack(self) -> dict[str, bytes | int]:
        return {"dims": self.x.shape[1], "ids": self.ids.tobytes(), "x": self.x.tobytes(), "lo": self.lo.tobytes(),
                "hi": self.hi.tobytes(), "kids": self.left.tobytes(), "centre": self.centre.tobytes(), "radius": self.radius.tobytes()}

    @classmethod
    def unpack(cls, r: dict) -> Tree:
        t = cls.__new__(cls)
        t.ids, t.lo, t.hi, t.left = (np.frombuffer(r[k], np.int64) for k in ("ids", "lo", "hi", "kids"))
        t.x = np.frombuffer(r["x"], np.int64).reshape(-1, r["dims"])
        t.centre = np.frombuffer(r["centre"], np.float64).reshape(-1, r["dims"])
        t.radius = np.frombuffer(r["radius"], np.float64)
        return t


_FIELDS = "dims int, ids binary, x binary, lo binary, hi binary, kids binary, centre binary, radius binary"


def quantised(df: DataFrame, vector_col: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, or null if the vector takes no part."""
    v = F.col(vector_col)
    good = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(good, F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("bigint")))


def shards(vectors: DataFrame, rows: int = SHARD_ROWS) -> DataFrame:
    """One row per ball tree of ``vectors`` (id, x); a task holds one shard's rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def tree(dims: int) -> pa.RecordBatch:
            ids, xs = held.pop(dims)
            t = Tree(np.concatenate(ids), np.concatenate(xs)).pack()
            return pa.RecordBatch.from_arrays([pa.array([t["dims"]], pa.int32()), *(pa.array([t[k]], pa.binary()) for k in list(t)[1:])],
                                              names=list(t))

        for b in batches:
            ids = b.column(0).to_numpy()
            size = pa.compute.list_value_length(b.column(1)).to_numpy()
            for dims in np.unique(size).tolist():
                at = np.flatnonzero(size == dims)
                x = b.column(1).take(pa.array(at)).flatten().to_numpy().reshape(-1, dims)
                for a in range(0, len(at), rows):
                    h = held.setdefault(dims, ([], []))
                    h[0].append(ids[at[a:a + rows]])
                    h[1].append(x[a:a + rows])
                    if sum(map(len, h[0])) >= rows:
                        yield tree(dims)
        for dims in list(held):
            yield tree(dims)

    return vectors.select("id", "x").mapInArrow(run, _FIELDS)


class Search:
    """Best rows of a block of queries of one length, over the trees that it has seen."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k = ids, k
        big = float(np.abs(q).max(initial=0))
        self.q = q
        self.qf = q.astype(np.float64)
        self.norm = np.sqrt((self.qf ** 2).sum(axis=1))
        self.big = big
        self.best = np.full((len(ids), k), -np.inf)
        self.floor = floor
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def kth(self) -> np.ndarray:
        return np.maximum(self.floor, self.best.min(axis=1))

    def visit(self, t: Tree, probe: bool = False) -> None:
        exact = self.big * float(np.abs(t.x).max(initial=0)) * t.x.shape[1] < 2 ** 52
        bound = self.qf @ t.centre.T + self.norm[:, None] * t.radius[None, :]
        bound += 1e-9 * np.abs(bound) + 1e-6  # rounding never prunes
        alive = np.zeros(bound.shape, bool)
        alive[:, 0] = bound[:, 0] >= self.kth()
        for node in np.flatnonzero(t.left >= 0):  # breadth first: parents come before children
            for child in (t.left[node], t.left[node] + 1):
                alive[:, child] = alive[:, node] & (bound[:, child] >= self.kth())
        leaves = np.flatnonzero(t.left < 0)
        at = np.where(alive[:, leaves], bound[:, leaves], -np.inf)
        order = np.argsort(-at, axis=1, kind="stable")
        live = np.arange(len(self.ids))
        for turn in range(1 if probe else len(leaves)):  # every query's next best leaf
            leaf = order[live, turn]
            top = at[live, leaf]
            go = (top > -np.inf) & (top >= self.kth()[live])
            live, leaf = live[go], leaf[go]
            if not len(live):
                break
            by = np.argsort(leaf, kind="stable")
            cut = np.flatnonzero(np.diff(leaf[by])) + 1
            for group in np.split(by, cut):
                self._leaf(t, int(leaves[leaf[group[0]]]), live[group], exact)

    def _leaf(self, t: Tree, node: int, who: np.ndarray, exact: bool) -> None:
        a, b = t.lo[node], t.hi[node]
        ids = t.ids[a:b]
        score = self.qf[who] @ t.x[a:b].T.astype(np.float64) if exact else (self.q[who] @ t.x[a:b].T)
        near = np.where(ids[None, :] == self.ids[who][:, None], -np.inf, score.astype(np.float64))
        hit, col = np.nonzero(near >= np.maximum(self.kth()[who], -1e300)[:, None])
        self.found.append((who[hit], ids[col], score[hit, col].astype(np.int64)))
        both = np.concatenate((self.best[who], near), axis=1)
        self.best[who] = -np.partition(-both, self.k - 1, axis=1)[:, :self.k]

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score): the k best of each query, ties to the smaller id."""
        if not self.found:
            z = np.zeros(0, np.int64)
            return z, z, z
        who, ids, score = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((ids, -score, who))
        who, ids, score = who[order], ids[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        keep = place < self.k
        return self.ids[who[keep]], ids[keep], score[keep]


def _search(trees: DataFrame, block: list[tuple[int, list[int], float]], k: int, probe: bool) -> DataFrame:
    """(query_id, vec_id, score) of each task's best rows for a block of queries (id, vector, shared k-th score)."""
    by_dims: dict[int, list] = {}
    for q in block:
        by_dims.setdefault(len(q[1]), []).append(q)
    ready = {d: (np.array([q[0] for q in qs], np.int64), np.array([q[1] for q in qs], np.int64), np.array([q[2] for q in qs], np.float64))
             for d, qs in by_dims.items()}
    shared = trees.sparkSession.sparkContext.broadcast(ready)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: dict[int, list[Search]] = {}
        for b in batches:
            for i in range(b.num_rows):
                t = Tree.unpack({n: b.column(n)[i].as_py() for n in b.schema.names})
                d = t.x.shape[1]
                if d not in searches:
                    ids, q, floor = shared.value.get(d, (np.zeros(0, np.int64),) * 3)
                    searches[d] = [Search(ids[a:a + PART], q[a:a + PART], k, floor[a:a + PART]) for a in range(0, len(ids), PART)]
                for s in searches[d]:
                    s.visit(t, probe)
        for group in searches.values():
            for s in group:
                q, v, x = s.results()
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(x)], names=["query_id", "vec_id", "score"])

    return trees.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    by = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows of ``vectors`` among those with another id."""
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("bigint").alias("id"), quantised(df, vector_col, scale).alias("x")) \
                 .filter("id is not null and x is not null").distinct()

    trees = staged(shards(clean(vectors), shard_rows))
    asked = clean(queries)
    n = asked.count()
    blocks = max(1, -(-n // block))
    out = None
    for i in range(blocks):
        part = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i)
        some = [(r["id"], r["x"], -np.inf) for r in part.collect()]
        probed = _best(_search(trees, some, k, True), k).filter(F.col("rank") == k).select("query_id", "score").collect()
        kth = {r["query_id"]: float(r["score"]) for r in probed}
        several = {q for q, m in _counts(some).items() if m > 1}  # an id with two vectors shares no score
        some = [(q, x, -np.inf if q in several else kth.get(q, -np.inf)) for q, x, _ in some]
        found = _best(_search(trees, some, k, False), k)
        found = staged(found) if blocks > 1 else found
        out = found if out is None else out.unionByName(found)
    return out.select("query_id", "rank", "vec_id", "score")


def _counts(some: list) -> dict[int, int]:
    out: dict[int, int] = {}
    for q, _, _ in some:
        out[q] = out.get(q, 0) + 1
    return out
