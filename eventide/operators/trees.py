"""Tables of trees: nodes (tree_id, node_id, parent_id, ord/side, val).

Level order, encoding, paths, roots, LCA and BST-bound lookups use pointer jumping /
binary lifting (O(log depth) rounds).
Sibling ranks use range-partitioned ranks, so a node with a huge fan-out is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cols
from ..session import cut_lineage, drop_staged, staged
from .scan import checked_broadcast, global_rank, running, same


def ordered(nodes: DataFrame, tree: str = "tree_id", node: str = "node_id", parent: str = "parent_id",
            ord_col: str = "ord") -> DataFrame:
    """(tree, node, depth, place) of the nodes below a root; ``place`` numbers all nodes by tree, depth and path,
    siblings by (ord, node).

    In rounds as many as the logarithm of the depth: pointer doubling gives each node's depth and, round by round,
    its 2^k-th ancestor.  A node's place by the last 2^k steps of its path and that of its 2^k-th ancestor give its
    place by the last 2^(k+1) steps.  Nodes that no root reaches (a missing parent, a cycle) are left out.
    """
    key = F.struct(F.col(tree).alias("t"), F.col(node).alias("n"))
    up = F.when(F.col(parent).isNotNull(), F.struct(F.col(tree).alias("t"), F.col(parent).alias("n")))
    base = staged(nodes.select(key.alias("v"), up.alias("a"), F.col(ord_col).alias("o")))
    n, ups = base.count(), []
    cur = base.select("v", "a", F.col("a").isNotNull().cast("bigint").alias("depth"), F.lit(False).alias("lost"))
    while True:
        cur = staged(cur)
        ups.append(cur)
        if 1 << (len(ups) - 1) > n or cur.filter("a IS NOT NULL AND NOT lost").isEmpty():
            break
        far = cur.select(F.col("v").alias("a"), F.col("a").alias("b"), F.col("depth").alias("more"), F.col("lost").alias("gone"))
        j = cur.join(far, "a", "left")
        cur = j.select("v", F.col("b").alias("a"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                       (F.col("lost") | F.coalesce("gone", F.col("a").isNotNull())).alias("lost"))
    found = cur.filter("NOT lost AND a IS NULL").select("v", "depth")
    at = global_rank(found.join(base.select("v", "o"), "v"), ["v.t", "depth", "o", "v.n"], "place").select("v", "depth", "place")
    for step in ups[:-1]:
        of = step.filter("a IS NOT NULL").select("v", "a").join(at.select(F.col("v").alias("a"), F.col("place").alias("before")), "a")
        both = at.join(of.select("v", "before"), "v", "left").withColumn("before", F.coalesce("before", F.lit(-1)))
        at = global_rank(both.withColumn("t", F.col("v.t")), ["t", "depth", "before", "place"], "next") \
            .select("v", "depth", F.col("next").alias("place"))
    for step in (*ups, base):
        drop_staged(step)
    return at.select(F.col("v.t").alias(tree), F.col("v.n").alias(node), "depth", "place")


def level_order(nodes: DataFrame, tree: str = "tree_id", node: str = "node_id", parent: str = "parent_id",
                ord_col: str = "ord") -> DataFrame:
    """(tree, depth, pos, node): nodes grouped by depth, left to right.

    pos at depth d+1 orders children by (parent's pos, own ordinal).
    """
    at = ordered(nodes, tree, node, parent, ord_col)
    first = at.groupBy(F.col(tree).alias("_t"), F.col("depth").alias("_d")).agg(F.min("place").alias("_first"))
    same = at[tree].eqNullSafe(first["_t"]) & (at["depth"] == first["_d"])
    return at.join(first, same).select(tree, "depth", (F.col("place") - F.col("_first")).alias("pos"), node)


def jump_tables(nodes: DataFrame, tree: str = "tree_id", node: str = "node_id",
                parent: str = "parent_id", max_levels: int = 64) -> list[DataFrame]:
    """Binary-lifting tables: ``up[k]`` = (tree, v, a) with a the 2^k-th
    ancestor of v.  O(log depth) self-joins, n rows per level at most."""
    up0 = cut_lineage(nodes.filter(F.col(parent).isNotNull())
                           .select(tree, F.col(node).alias("v"), F.col(parent).alias("a")))
    up = [up0]
    for _ in range(max_levels):
        x, y = up[-1].alias("x"), up[-1].alias("y")
        nxt = cut_lineage(x.join(y, (F.col("x.a") == F.col("y.v")) & (F.col(f"x.{tree}") == F.col(f"y.{tree}")))
                           .select(F.col(f"x.{tree}").alias(tree), F.col("x.v").alias("v"), F.col("y.a").alias("a")))
        if nxt.limit(1).count() == 0:
            return up
        up.append(nxt)
    raise RuntimeError("tree deeper than 2^max_levels (or a cycle)")


def depths(nodes: DataFrame, up: list[DataFrame], tree: str = "tree_id", node: str = "node_id") -> DataFrame:
    """(tree, v, depth) by jumping from each node with the largest steps first."""
    cur = nodes.select(tree, F.col(node).alias("v"), F.col(node).alias("_c"), F.lit(0).cast("bigint").alias("depth"))
    for k in range(len(up) - 1, -1, -1):
        t = up[k].select(tree, F.col("v").alias("_c"), F.col("a").alias("_a"))
        cur = cut_lineage(cur.join(t, [tree, "_c"], "left")
                             .select(tree, "v", F.coalesce("_a", "_c").alias("_c"),
                                     (F.col("depth") + F.when(F.col("_a").isNotNull(), F.lit(1 << k))
                                      .otherwise(F.lit(0))).alias("depth")))
    return cur.select(tree, "v", "depth")


def _step(df: DataFrame, t: DataFrame, tree: str, col: str, when) -> DataFrame:
    """Replace ``col`` by its ancestor from table t where ``when`` holds."""
    j = df.join(t.select(tree, F.col("v").alias(col), F.col("a").alias("_up")), [tree, col], "left")
    return j.withColumn(col, F.when(when & F.col("_up").isNotNull(), F.col("_up")).otherwise(F.col(col))).drop("_up")


def lca(nodes: DataFrame, pairs: DataFrame, tree: str = "tree_id", node: str = "node_id",
        parent: str = "parent_id") -> DataFrame:
    """Lowest common ancestor per (tree, a, b) pair by binary lifting; a
    node may be its own ancestor; null when a node is missing or the two
    share no ancestor.  O(log depth) rounds of equi-joins, no ancestor
    closure (which would be quadratic for a chain)."""
    up = jump_tables(nodes, tree, node, parent)
    dep = depths(nodes, up, tree, node)
    p = (pairs.select(tree, "a", "b")
              .join(dep.select(tree, F.col("v").alias("a"), F.col("depth").alias("_da")), [tree, "a"], "left")
              .join(dep.select(tree, F.col("v").alias("b"), F.col("depth").alias("_db")), [tree, "b"], "left"))
    deeper = F.col("_da") >= F.col("_db")
    w = p.select(tree, "a", "b", "_da", "_db",
                 F.when(deeper, F.col("a")).otherwise(F.col("b")).alias("_x"),
                 F.when(deeper, F.col("b")).otherwise(F.col("a")).alias("_y"),
                 F.abs(F.col("_da") - F.col("_db")).alias("_diff"))
    for k in range(len(up)):  # lift the deeper node by the depth difference
        w = cut_lineage(_step(w, up[k], tree, "_x", (F.shiftright("_diff", k) % 2) == 1))
    for k in range(len(up) - 1, -1, -1):  # climb together while the ancestors differ
        t = up[k].select(tree, F.col("v"), F.col("a"))
        j = (w.join(t.select(tree, F.col("v").alias("_x"), F.col("a").alias("_ux")), [tree, "_x"], "left")
              .join(t.select(tree, F.col("v").alias("_y"), F.col("a").alias("_uy")), [tree, "_y"], "left"))
        move = (F.col("_x") != F.col("_y")) & F.col("_ux").isNotNull() & F.col("_uy").isNotNull() \
            & (F.col("_ux") != F.col("_uy"))
        w = cut_lineage(j.withColumn("_x", F.when(move, F.col("_ux")).otherwise(F.col("_x")))
                         .withColumn("_y", F.when(move, F.col("_uy")).otherwise(F.col("_y")))
                         .drop("_ux", "_uy"))
    par = up[0].select(tree, F.col("v"), F.col("a")) if up else None
    w = (w.join(par.select(tree, F.col("v").alias("_x"), F.col("a").alias("_px")), [tree, "_x"], "left")
          .join(par.select(tree, F.col("v").alias("_y"), F.col("a").alias("_py")), [tree, "_y"], "left"))
    known = F.col("_da").isNotNull() & F.col("_db").isNotNull()
    res = (F.when(~known, F.lit(None))
            .when(F.col("_x") == F.col("_y"), F.col("_x"))
            .when(F.col("_px").isNotNull() & (F.col("_px") == F.col("_py")), F.col("_px")))
    return w.select(tree, "a", "b", res.cast(nodes.schema[node].dataType).alias("lca"))


def roots(nodes: DataFrame, node: str = "node_id", parent: str = "parent_id", max_rounds: int = 64) -> DataFrame:
    """(node, root) by pointer jumping: O(log depth) self-joins."""
    r = cut_lineage(nodes.select(F.col(node).alias("v"), F.coalesce(F.col(parent), F.col(node)).alias("r")))
    for _ in range(max_rounds):
        x, y = r.alias("x"), r.alias("y")
        nxt = cut_lineage(x.join(y, F.col("x.r") == F.col("y.v"), "left")
                           .select(F.col("x.v").alias("v"), F.coalesce(F.col("y.r"), F.col("x.r")).alias("r")))
        if nxt.join(r, ["v", "r"], "left_anti").limit(1).count() == 0:
            return nxt.select(F.col("v").alias(node), F.col("r").alias("root"))
        r = nxt
    raise RuntimeError("roots did not converge (cycle?)")


def _nearest_turn(nodes: DataFrame, tree: str, node: str, parent: str, side: str, want: int,
                  max_rounds: int = 64) -> DataFrame:
    """(tree, v, anc): the nearest ancestor whose ``want``-side subtree holds v,
    i.e. the parent of the first node on v's upward path that is a
    ``want``-side child.  Pointer jumping: O(log depth) rounds."""
    st = cut_lineage(nodes.select(
        tree, F.col(node).alias("v"),
        (F.col(parent).isNull() | (F.col(side) == want)).alias("done"),
        F.col(parent).alias("x")))
    for _ in range(max_rounds):
        if st.filter(~F.col("done")).limit(1).count() == 0:
            return st.select(tree, "v", F.col("x").alias("anc"))
        t = st.select(tree, F.col("v").alias("x"), F.col("done").alias("_td"), F.col("x").alias("_tx"))
        j = st.join(t, [tree, "x"], "left")
        # a pointer to a node that is not in the table ends the chain (like a root)
        st = cut_lineage(j.select(
            tree, "v",
            (F.col("done") | F.col("_td").isNull() | F.col("_td")).alias("done"),
            F.when(F.col("done"), F.col("x")).when(F.col("_td").isNull(), F.lit(None))
             .otherwise(F.col("_tx")).alias("x")))
    raise RuntimeError("tree deeper than 2^max_rounds (or a cycle)")


def validate_ordered_tree(nodes: DataFrame, tree: str = "tree_id", node: str = "node_id",
                          parent: str = "parent_id", side: str = "side", val: str = "val") -> DataFrame:
    """Binary search tree check: each node strictly inside the (lo, hi)
    bounds inherited from its ancestors.  lo is the value of the nearest
    ancestor reached through a right-child link, hi through a left-child
    link; both come from pointer jumping (O(log depth) rounds, not one per
    level).  Empty trees are valid."""
    lo = _nearest_turn(nodes, tree, node, parent, side, 1)
    hi = _nearest_turn(nodes, tree, node, parent, side, 0)
    vals = nodes.select(tree, F.col(node).alias("anc"), F.col(val).alias("_av"))
    b = (nodes.select(tree, F.col(node).alias("v"), F.col(val).alias("_v"))
              .join(lo.join(vals, [tree, "anc"], "left").select(tree, "v", F.col("_av").alias("_lo")), [tree, "v"], "left")
              .join(hi.join(vals, [tree, "anc"], "left").select(tree, "v", F.col("_av").alias("_hi")), [tree, "v"], "left"))
    ok = (F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") < F.col("_hi")))
    return b.groupBy(tree).agg(F.bool_and(ok).alias("valid"))


def encode_trees(nodes: DataFrame, tree: str = "tree_id", node: str = "node_id", parent: str = "parent_id",
                 side: str = "side", val: str = "val", brackets: bool = False) -> DataFrame:
    """Level-order string per binary tree with 'null' holes, trailing nulls trimmed, on request in brackets.

    The k-th non-null node in level order owns slots 2k+1 (left) and 2k+2
    (right), so a node's slot follows from its parent's number; the string, which
    is the result, is then assembled per tree.
    """
    at = ordered(nodes, tree, node, parent, side)
    first = at.groupBy(F.col(tree).alias("_t")).agg(F.min("place").alias("_first"))
    at = at.join(first, at[tree].eqNullSafe(first["_t"])).select(F.col(tree).alias("_t"), F.col(node).alias("_n"), (F.col("place") - F.col("_first")).alias("rank"))
    rows = nodes.select(tree, node, parent, side, val)
    below = rows.join(at, rows[tree].eqNullSafe(at["_t"]) & (rows[parent] == at["_n"]), "left").drop("_t", "_n")
    out = below.filter(F.col(parent).isNull() | F.col("rank").isNotNull()).select(
        tree, val, F.when(F.col(parent).isNull(), F.lit(0)).otherwise(2 * F.col("rank") + 1 + F.col(side)).cast("bigint").alias("slot"))
    # each token, after a hole for every slot skipped
    per = out.groupBy(tree).agg(F.array_sort(F.collect_list(F.struct("slot", F.col(val).cast("string").alias("v")))).alias("_s"))
    gap = lambda x, i: x["slot"] - F.coalesce(F.get("_s", i - 1)["slot"], F.lit(-1)) - 1
    text = F.array_join(F.transform("_s", lambda x, i: F.concat(F.repeat(F.lit("null,"), gap(x, i).cast("int")), F.coalesce(x["v"], F.lit("null")))), ",")
    return per.select(tree, (F.concat(F.lit("["), text, F.lit("]")) if brackets else text).alias("data"))


def decode_trees(enc: DataFrame, tree: str = "tree_id", data: str = "data") -> DataFrame:
    """Inverse of ``encode_trees``: node id = level-order rank of the token,
    parent = rank (i - 1) div 2, side = (i - 1) mod 2, for token index i.

    Brackets around the tokens and spaces around each are allowed; an empty tree
    ("", "[]" or a null root) has no rows."""
    inner = F.regexp_replace(F.trim(F.col(data)), r"^\[|\]$", "")
    tok = enc.select(tree, F.posexplode(F.transform(F.split(inner, ","), lambda t: F.trim(t))).alias("i", "tok")) \
             .filter((F.col("tok") != "null") & (F.col("tok") != ""))
    tok = tok.withColumn("i", F.col("i").cast("bigint"))
    ranked = running(tok, tree, ["i"], {"_n": ("count", "_n")}).withColumn("node_id", F.col("_n") - 1)
    # the token at index i >= 1 hangs under the non-null token number (i - 1) div 2
    return ranked.select(tree, "node_id",
                         F.when(F.col("i") > 0, F.expr("(i - 1) div 2")).alias("parent_id"),
                         F.when(F.col("i") > 0, F.expr("(i - 1) % 2")).cast("int").alias("side"),
                         F.col("tok").alias("val"))


def paths(nodes: DataFrame, tree: str | Sequence[str] = "tree_id", node: str = "node_id", parent: str = "parent_id",
          ord_col: str = "ord") -> DataFrame:
    """(tree, node, path) with path = child ordinals from the root ('0/2/1'), siblings in order of (ord, node).

    In rounds as many as the logarithm of the depth: after k rounds a node has the last 2^k steps of its path
    and its 2^k-th ancestor, whose own steps go before them.  Nodes that no root reaches (a missing parent, a
    cycle) are left out.
    """
    ts = cols(tree)
    key = lambda c: F.struct(*ts, F.col(c).alias("_n"))
    sib = running(nodes.select(*dict.fromkeys([*ts, node, parent, ord_col])), [*ts, parent], [ord_col, node], {"_o": ("count", "_o")})
    cur = staged(sib.select(key(node).alias("v"), F.when(F.col(parent).isNotNull(), key(parent)).alias("a"),
                            (F.col("_o") - 1).cast("string").alias("path")))
    n, steps = cur.count(), 1
    while steps <= n and not cur.filter("a IS NOT NULL").isEmpty():
        far = cur.select(F.col("v").alias("a"), F.col("a").alias("b"), F.col("path").alias("up"))
        on = cur.join(far, "a").select("v", F.col("b").alias("a"), F.concat_ws("/", "up", "path").alias("path"))
        longer = staged(on.unionByName(cur.filter("a IS NULL")))
        drop_staged(cur)
        cur, steps = longer, 2 * steps
    return cur.filter("a IS NULL").select(*[F.col("v")[t].alias(t) for t in ts], F.col("v._n").alias(node), "path")


def hierarchy_diff(a: DataFrame, b: DataFrame, tree: str = "tree_id", node: str = "node_id",
                   parent: str = "parent_id", ord_col: str = "ord", val: str = "val") -> DataFrame:
    """Paths whose value differs between two ordered N-ary forests (a node of one side only is a difference).

    Trees whose nodes are the same rows on both sides are left out first, in one aggregation; the others' paths
    are built for both sides together and compared.  A null value equals a null value.
    """
    names = [tree, node, parent, ord_col, val]
    # written once: it is read for the aggregation and again for the trees that differ
    both = staged(a.select(*names, F.lit(0).alias("_side")).unionByName(b.select(*names, F.lit(1).alias("_side"))))
    what = F.struct(parent, ord_col, val)
    nodes = both.groupBy(tree, node).agg(F.count_if(F.col("_side") == 0).alias("l"), F.count_if(F.col("_side") == 1).alias("r"),
                                         F.min(what).alias("lo"), F.max(what).alias("hi"))
    odd, _ = checked_broadcast(nodes.filter("NOT (l = 1 AND r = 1 AND lo <=> hi)").select(F.col(tree).alias("_t")).distinct())
    rows = staged(both.join(odd, both[tree].eqNullSafe(odd["_t"]), "left_semi"))
    drop_staged(both)
    at = paths(rows, ["_side", tree], node, parent, ord_col)
    vals = rows.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(("_side", tree, node))], val)
    at = at.join(vals, same(at, vals, [(c, f"_{i}") for i, c in enumerate(("_side", tree, node))]))
    side = lambda i: F.first(F.when(F.col("_side") == i, F.col(val)), ignorenulls=True)
    per = at.groupBy(tree, "path").agg(side(0).alias("val_a"), side(1).alias("val_b"), F.count_distinct("_side").alias("_n"))
    return per.filter("_n = 1 OR NOT val_a <=> val_b").select(tree, "path", "val_a", "val_b")
