"""Iterative graph jobs as DataFrame joins that run to a fixed point.

Every loop cuts lineage each round with a reliable checkpoint (into the
session's ``spark.checkpoint.dir``), stops when the frontier is empty or
nothing changes, and raises if the round bound is hit.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cols
from ..session import bounded_tasks, cut_lineage, drop_staged, staged
from .scan import global_rank

WORDS = 8  # of 64 searches each in a row of the hub search


def _checksum(df: DataFrame, c1: str, c2: str):
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64(c1, c2).cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         nodes: DataFrame | None = None, node: str = "node",
                         max_rounds: int = 200) -> DataFrame:
    """Component id (= smallest node id) per node of an undirected graph.

    Alternating large-star / small-star rounds (Kiveris et al., 2014):
    O(log n) rounds; the edge set shrinks to one star per component.
    Large-star emits (v, m) with v > m only, which is exactly the
    "smaller neighbours" input small-star needs, so a round is: a grouped
    min and join, another grouped min and join, and a distinct of the pairs.
    A hub's minimum is combined in the tasks before the shuffle; the joins hash
    the minima, one row per node, and let the pairs stream by unsorted, so a task
    holds no hub's edges.  Tasks are of bounded size.  ``nodes`` adds isolated nodes.
    """
    with bounded_tasks(edges.sparkSession) as rows:
        out = staged(_components(edges.select(F.col(src).cast("bigint").alias("u"), F.col(dst).cast("bigint").alias("v")),
                                 node, max_rounds, rows))
    if nodes is not None:
        iso = (nodes.select(F.col(node).cast("bigint").alias(node)).distinct()
                    .join(out.select(node), node, "left_anti")
                    .withColumn("component", F.col(node)))
        out = out.unionByName(iso)
    return out


def _components(edges: DataFrame, node: str, max_rounds: int, rows: Callable[[int], None]) -> DataFrame:
    e = edges.filter(F.col("u") != F.col("v"))
    d = staged(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    prev = _checksum(d, "u", "v")
    rows(prev[0])
    for _ in range(max_rounds):
        # large star: every larger neighbour of u links to the smallest of u's closed neighbourhood
        m = d.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        low = (d.filter(F.col("v") > F.col("u")).join(m.hint("shuffle_hash"), "u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its smaller neighbours link to the smallest of them
        m2 = low.groupBy("u").agg(F.min("v").alias("m"))
        ss = (low.join(m2.hint("shuffle_hash"), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .unionByName(m2.select(F.col("u").alias("a"), F.col("m").alias("b")))
                 .filter(F.col("a") != F.col("b")))
        both = ss.unionByName(ss.select(F.col("b").alias("a"), F.col("a").alias("b")))
        old, d = d, staged(both.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
        drop_staged(old)
        cur = _checksum(d, "u", "v")
        if cur == prev:
            return d.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("component")).select(F.col("u").alias(node), "component")
        prev = cur
    raise RuntimeError("connected_components did not converge")


def count_islands(cells: DataFrame, grid: str = "grid_id", r: str = "r", c: str = "c",
                  land: str = "land") -> DataFrame:
    """Number of 4-connected land components per grid (0 for a grid without land)."""
    grids = cells.select(grid).distinct()
    lnd = global_rank(cells.filter(F.col(land)).select(grid, r, c).distinct(), [grid, r, c], "id")
    right = lnd.select(grid, F.col(r).alias("_r"), (F.col(c) - 1).alias("_c"), F.col("id").alias("nb"))
    down = lnd.select(grid, (F.col(r) - 1).alias("_r"), F.col(c).alias("_c"), F.col("id").alias("nb"))
    a = lnd.select(grid, F.col(r).alias("_r"), F.col(c).alias("_c"), "id")
    edges = (a.join(right, [grid, "_r", "_c"]).select(F.col("id").alias("src"), F.col("nb").alias("dst"))
              .unionByName(a.join(down, [grid, "_r", "_c"]).select(F.col("id").alias("src"), F.col("nb").alias("dst"))))
    comp = connected_components(edges, nodes=lnd.select(F.col("id").alias("node")))
    per = (lnd.join(comp, lnd["id"] == comp["node"]).groupBy(grid)
              .agg(F.count_distinct("component").alias("islands")))
    return grids.join(per, grid, "left").select(grid, F.coalesce("islands", F.lit(0)).cast("bigint").alias("islands"))


def topo_levels(nodes: DataFrame, edges: DataFrame, keys=(), node: str = "node",
                src: str = "src", dst: str = "dst", max_rounds: int = 10_000) -> DataFrame:
    """Kahn layering: level = round in which a node's in-degree reaches 0.

    Nodes never reaching in-degree 0 (on or after a cycle) get a null
    level; ``has_cycle`` per graph.  A round joins the newest level with the
    edges, takes what it frees from the in-degrees of the nodes it points to, and
    writes one table: the nodes reached so far that still wait, and those that are free now.
    """
    k = cols(keys)
    nd = nodes.select(*k, node).distinct()
    e = staged(edges.select(*k, F.col(src).alias("_s"), F.col(dst).alias(node)).distinct())
    into = staged(e.groupBy(*k, node).agg(F.count(F.lit(1)).alias("_in")).join(nd, [*k, node], "left_semi"))
    ready = staged(nd.join(into, [*k, node], "left_anti"))
    done = ready.withColumn("level", F.lit(0).cast("bigint"))
    wait = None
    for level in range(1, max_rounds + 1):
        freed = ready.withColumnRenamed(node, "_s").join(e, [*k, "_s"]).groupBy(*k, node).agg(F.count(F.lit(1)).alias("_free"))
        freed = freed.join(into, [*k, node])
        if wait is None:
            left = freed.select(*k, node, (F.col("_in") - F.col("_free")).alias("_left"))
        else:
            left = wait.join(freed, [*k, node], "full").select(
                *k, node, (F.coalesce("_left", "_in") - F.coalesce("_free", F.lit(0))).alias("_left"))
        left = staged(left)
        ready, wait = left.filter("_left = 0").select(*k, node), left.filter("_left > 0")
        if ready.isEmpty():
            break
        done = done.unionByName(ready.withColumn("level", F.lit(level).cast("bigint")))
    else:
        raise RuntimeError("topo_levels hit the round bound")
    stuck = into.select(*k, node).join(done, [*k, node], "left_anti").withColumn("level", F.lit(None).cast("bigint"))
    out = done.unionByName(stuck)
    if not k:
        return out.withColumn("has_cycle", F.lit(not stuck.isEmpty()))
    cyc = stuck.select(*k).distinct().withColumn("_c", F.lit(True))
    return out.join(cyc, k, "left").withColumn("has_cycle", F.coalesce("_c", F.lit(False))).drop("_c")


def bfs(edges: DataFrame, sources: DataFrame, key: str = "source", src: str = "src", dst: str = "dst",
        undirected: bool = True, targets: DataFrame | None = None, max_rounds: int = 10_000) -> DataFrame:
    """Hop distance from each source (a ``key`` -> start node table) to every reachable node.

    sources: (key, node).  Returns (key, node, dist).  Each round joins
    only the current frontier with the edges.  In an undirected graph a
    node first seen now cannot lie in any layer older than the previous
    one, so new nodes are anti-joined with the last two layers only and
    the visited set is never rewritten; directed graphs anti-join the union of all
    (checkpointed) layers.  With ``targets`` (key, node) a key stops
    expanding once its target is reached.
    """
    e = edges.select(F.col(src).alias("_a"), F.col(dst).alias("_b"))
    if undirected:
        e = e.unionByName(e.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
    e = staged(e.distinct())
    frontier = cut_lineage(sources.select(key, "node").distinct().withColumn("dist", F.lit(0).cast("bigint")))
    layers = [frontier]
    prev = None
    done_keys = None
    tg = targets.select(key, "node").distinct() if targets is not None else None
    for step in range(1, max_rounds + 1):
        if tg is not None:
            hit = frontier.join(tg, [key, "node"], "left_semi").select(key).distinct()
            done_keys = cut_lineage(hit if done_keys is None else done_keys.unionByName(hit).distinct())
            frontier = frontier.join(done_keys, key, "left_anti")
        nxt = (frontier.join(e, frontier["node"] == e["_a"]).select(key, F.col("_b").alias("node")).distinct()
                       .join(frontier.select(key, "node"), [key, "node"], "left_anti"))
        if undirected:
            if prev is not None:
                nxt = nxt.join(prev.select(key, "node"), [key, "node"], "left_anti")
        else:
            older = [layer.select(key, "node") for layer in layers[:-1]]
            if older:
                nxt = nxt.join(reduce(DataFrame.union, older), [key, "node"], "left_anti")
        nxt = cut_lineage(nxt.withColumn("dist", F.lit(step).cast("bigint")))
        if nxt.limit(1).count() == 0:
            out = layers[0]
            for layer in layers[1:]:
                out = out.unionByName(layer)
            return out
        layers.append(nxt)
        prev, frontier = frontier, nxt
    raise RuntimeError("bfs hit the round bound")


def pair_distance(edges: DataFrame | None, pairs: DataFrame, src: str = "src", dst: str = "dst",
                  hubs: DataFrame | None = None, max_rounds: int = 10_000, near: str | None = None) -> DataFrame:
    """Shortest hop count per (pair_id, start, end) of an undirected graph; null when unreachable.

    A search belongs to a node, not to a pair: pairs with a common end share its
    layers, and equal pairs (either way round) are asked once.  Over edges every pair is
    searched from both ends, one layer per round.  A path of 2r - 1 or 2r steps has a node
    r steps from one end and r - 1 or r from the other, so round r only compares the newest
    layers of a pair's ends.  A pair stops when they meet or when either search runs out of
    new nodes, so an isolated end costs one round; a search stops with its last pair.

    With ``hubs`` (node, hub) instead of edges, two nodes are adjacent
    when they share a hub (e.g. words sharing a wildcard pattern); a round
    goes node -> hub -> node without ever forming the node pairs of a hub.  A pair is searched from the
    end that more pairs share, and 64 * ``WORDS`` searches are a block: a node's row has a bit for each
    that is there now, so a round costs rows by blocks and not by searches, and a pair looks at its other end alone.
    ``near`` names a column of the pairs, such as their component: searches with equal values share blocks.
    Tasks are of bounded size.
    """
    with bounded_tasks(pairs.sparkSession) as rows:
        if hubs is not None:
            return staged(_hub_distance(hubs, pairs, near, 2 * max_rounds, rows))
        return staged(_pair_distance(edges, pairs, src, dst, max_rounds, rows))


def _ends() -> list:
    """The ends of a pair, the same either way round."""
    return [F.least("start", "end").alias("_x"), F.greatest("start", "end").alias("_y")]


def _told(p: DataFrame, found: DataFrame | None) -> DataFrame:
    """The pairs with the hops found for their ends."""
    dist = F.when(F.col("start") == F.col("end"), F.lit(0).cast("bigint"))
    if found is None:
        return p.withColumn("dist", dist)
    asked = p.withColumns(dict(zip(("_x", "_y"), _ends())))
    return asked.join(found, ["_x", "_y"], "left").select("pair_id", "start", "end", F.coalesce(dist, F.col("dist")).alias("dist"))


def _hub_distance(hubs: DataFrame, pairs: DataFrame, near: str | None, max_rounds: int, rows: Callable[[int], None]) -> DataFrame:
    # bits travel as one array: with a column each, a filter on them sends the optimizer through all sets of the columns
    each = range(WORDS)
    none, own = F.lit(0).cast("bigint"), F.expr("shiftleft(1L, _bit)")
    mark = [F.when(F.col("_word") == i, own).otherwise(none) for i in each]
    some = F.expr(f"_bits <> array_repeat(0L, {WORDS})")
    alive = F.array(*[F.expr(f"_bits[{i}] & _live[{i}]") for i in each]).alias("_bits")
    met = [F.expr(f"bit_or(_bits[{i}])").alias(f"_n{i}") for i in each]
    come = [F.col(c) for c in ("_block", "node", *(f"_n{i}" for i in each))] + [none.alias(f"_o{i}") for i in each]
    been = [F.col("_block"), F.col("node"), *[none.alias(f"_n{i}") for i in each], *[F.expr(f"_bits[{i}]").alias(f"_o{i}") for i in each]]
    both = [F.expr(f"bit_or(_{c}{i})").alias(f"_{c}{i}") for c in "no" for i in each]
    fresh = F.array(*[F.expr(f"_n{i} & ~_o{i}") for i in each]).alias("_bits")
    living = F.array(*[F.bit_or(m) for m in mark]).alias("_live")
    there = F.coalesce(F.expr("shiftright(_bits[_word], _bit) & 1L = 1"), F.lit(False)).alias("_hit")
    e = staged(hubs.select("node", "hub").distinct())
    links = e.count()
    rows(links)
    p = pairs.select("pair_id", "start", "end")
    asked = staged(pairs.filter(F.col("start") != F.col("end")).select(*_ends(), (F.col(near) if near else F.lit(None)).alias("_near"))
                   .groupBy("_x", "_y").agg(F.min("_near").alias("_near")))
    uses = asked.select(F.explode(F.array("_x", "_y")).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    asked = asked.join(uses.select(F.col("n").alias("_x"), F.col("c").alias("_cx")), "_x").join(uses.select(F.col("n").alias("_y"), F.col("c").alias("_cy")), "_y")
    first = F.col("_cx") >= F.col("_cy")
    asked = staged(asked.select("_x", "_y", "_near", F.when(first, F.col("_x")).otherwise(F.col("_y")).alias("origin"),
                                F.when(first, F.col("_y")).otherwise(F.col("_x")).alias("node")))
    origins = global_rank(asked.groupBy("origin").agg(F.min("_near").alias("_near")), ["_near", "origin"], "_r")
    origins = origins.select("origin", F.expr(f"_r div {64 * WORDS}").alias("_block"), F.expr(f"cast(_r div 64 % {WORDS} as int)").alias("_word"), F.expr("cast(_r % 64 as int)").alias("_bit"))
    open_ = staged(asked.join(origins, "origin").select("_x", "_y", "_block", "_word", "_bit", "node"))
    front, before = staged(origins.select("_block", F.col("origin").alias("node"), F.array(*mark).alias("_bits"))), None
    found = None
    for r in range(1, max_rounds + 1):
        if open_.isEmpty():
            break
        live = open_.groupBy("_block").agg(living)
        at = front.join(F.broadcast(live), "_block").select("_block", "node", alive).filter(some)
        at = at.join(e.hint("shuffle_hash"), "node").groupBy("_block", "hub").agg(*met)
        at = at.join(e.hint("shuffle_hash"), "hub").select(*come)
        for old in [front] if before is None else [front, before]:  # older layers are no neighbours of the newest
            at = at.unionByName(old.select(*been))
        new = staged(at.groupBy("_block", "node").agg(*both).select("_block", "node", fresh).filter(some))
        reached = new.count()
        rows(max(links, WORDS * reached))
        tried = staged(open_.join(new, ["_block", "node"], "left").select("_x", "_y", "_block", "_word", "_bit", "node", there))
        hit = tried.filter("_hit").select("_x", "_y", F.lit(r).cast("bigint").alias("dist"))
        found = hit if found is None else found.unionByName(hit)
        if before is not None:
            drop_staged(before)
        open_, before, front = tried.filter("not _hit").drop("_hit"), front, new
        if not reached:  # the rest is out of reach
            break
    else:
        raise RuntimeError("pair_distance hit the round bound")
    return _told(p, found)


def _pair_distance(edges: DataFrame, pairs: DataFrame, src: str, dst: str, max_rounds: int, rows: Callable[[int], None]) -> DataFrame:
    e = edges.select(F.col(src).alias("_a"), F.col(dst).alias("_b"))
    e = staged(e.unionByName(e.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"))).distinct())
    rows(e.count())

    def around(front):
        return front.join(e, front["node"] == e["_a"]).select("origin", F.col("_b").alias("node")).distinct()

    def meet(x, y, dist):
        at = open_.join(x.select(F.col("origin").alias("_x"), "node"), "_x")
        return at.join(y.select(F.col("origin").alias("_y"), "node"), ["_y", "node"]).select("_x", "_y", F.lit(dist).cast("bigint").alias("dist"))

    p = pairs.select("pair_id", "start", "end")
    open_ = staged(p.filter(F.col("start") != F.col("end")).select(*_ends()).distinct())
    origins = lambda: open_.select(F.col("_x").alias("origin")).union(open_.select("_y")).distinct()
    front, before = staged(origins().withColumn("node", F.col("origin"))), None
    found = None
    for r in range(1, max_rounds + 1):
        if open_.isEmpty():
            break
        new = around(front.join(origins(), "origin", "left_semi")).join(front, ["origin", "node"], "left_anti")
        if before is not None:  # older layers are no neighbours of the newest
            new = new.join(before, ["origin", "node"], "left_anti")
        new = staged(new)
        hit = staged(meet(new, front, 2 * r - 1).unionByName(meet(new, new, 2 * r)).groupBy("_x", "_y").agg(F.min("dist").alias("dist")))
        found = hit if found is None else found.unionByName(hit)
        live = new.select("origin").distinct()
        still = staged(open_.join(hit, ["_x", "_y"], "left_anti").join(live.withColumnRenamed("origin", "_x"), "_x", "left_semi")
                       .join(live.withColumnRenamed("origin", "_y"), "_y", "left_semi").select("_x", "_y"))
        drop_staged(open_)
        if before is not None:
            drop_staged(before)
        open_, before, front = still, front, new
    else:
        raise RuntimeError("pair_distance hit the round bound")
    return _told(p, found)


def shortest_path_len(edges: DataFrame, pairs: DataFrame, src: str = "src", dst: str = "dst",
                      undirected: bool = True) -> DataFrame:
    """Hop count for each (pair_id, start, end), null when unreachable: searched from both ends, or along
    the edges' direction from the start alone."""
    if undirected:
        return pair_distance(edges, pairs, src=src, dst=dst).select("pair_id", "start", "end", "dist")
    with bounded_tasks(edges.sparkSession):
        d = bfs(edges, pairs.select(F.col("pair_id").alias("source"), F.col("start").alias("node")),
                src=src, dst=dst, undirected=False)
        return staged(pairs.join(d.withColumnRenamed("source", "pair_id").withColumnRenamed("node", "end"),
                                 ["pair_id", "end"], "left")
                           .select("pair_id", "start", "end", "dist"))


def reachable_subgraph(edges: DataFrame, seed, src: str = "src", dst: str = "dst") -> DataFrame:
    """Copy of the part of an undirected graph reachable from ``seed`` with
    fresh node ids (max id + 1 + rank of the old id).  Returns
    (old_src, old_dst, new_src, new_dst).  A null seed gives no rows.
    Tasks are of bounded size."""
    spark = edges.sparkSession
    if seed is None:
        return edges.limit(0).select(F.col(src).alias("old_src"), F.col(dst).alias("old_dst"),
                                     F.col(src).alias("new_src"), F.col(dst).alias("new_dst"))
    with bounded_tasks(spark) as rows:
        e = staged(edges.select(F.col(src).alias("old_src"), F.col(dst).alias("old_dst")))
        top = e.agg(F.greatest(F.max("old_src"), F.max("old_dst")).alias("m"), F.count(F.lit(1)).alias("n")).first()
        rows(2 * top["n"])
        s = spark.createDataFrame([(0, int(seed))], "source int, node bigint")
        reach = bfs(e, s, src="old_src", dst="old_dst").select("node").union(s.select("node")).distinct()
        base = max(int(seed) if top["m"] is None else int(top["m"]), int(seed)) + 1
        ids = global_rank(reach, ["node"], "_r").select("node", (F.col("_r") + F.lit(base)).alias("new_id"))
        a = ids.select(F.col("node").alias("old_src"), F.col("new_id").alias("new_src"))
        b = ids.select(F.col("node").alias("old_dst"), F.col("new_id").alias("new_dst"))
        return staged(e.join(a.hint("shuffle_hash"), "old_src").join(b.hint("shuffle_hash"), "old_dst")
                       .select("old_src", "old_dst", "new_src", "new_dst"))
