"""Graph, tree and text bindings.

Graph: every lineitem row is an order-part edge (order node = 2*o_orderkey,
part node = 2*l_partkey + 1).  Hierarchy: region -> nation -> customer ->
order, node id = kind * 2^56 + key.  Binary trees: parts of each brand
heap-numbered in p_partkey order.  Text: letter tokens of all documents;
dictionary = tokens of the benchmark texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graphs as G
from ..operators import sets as ST
from ..operators import text as TX
from ..operators import trees as TR
from ..operators.scan import running
from ..sources import load
from . import register

KIND = 1 << 56


def order_part_edges(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst")).distinct()


_EDGES = """e AS (SELECT DISTINCT l_orderkey * 2 AS a, l_partkey * 2 + 1 AS b FROM lineitem),
d AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e)"""


@register("connected_components", f"""
WITH RECURSIVE {_EDGES},
r(node, comp) USING KEY (node) AS (
    SELECT DISTINCT u, u FROM d
    UNION
    SELECT d.v, min(r.comp) FROM r JOIN d ON d.u = r.node JOIN recurring.r AS o ON o.node = d.v
    WHERE r.comp < o.comp GROUP BY d.v)
SELECT node, comp AS component FROM r
""")
def connected_components(spark, sf_dir):
    return G.connected_components(order_part_edges(spark, sf_dir))


@register("shortest_path_len", f"""
WITH RECURSIVE {_EDGES},
ends AS (SELECT c_nationkey AS pair_id, arg_min(o_orderkey, (o_orderdate, o_orderkey)) * 2 AS a,
                arg_max(o_orderkey, (o_orderdate, o_orderkey)) * 2 AS b
         FROM orders JOIN customer ON o_custkey = c_custkey
         WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1),
r(pair_id, node, dist) USING KEY (pair_id, node) AS (
    SELECT pair_id, a, 0 FROM ends
    UNION
    SELECT DISTINCT r.pair_id, d.v, r.dist + 1 FROM r JOIN d ON d.u = r.node
    WHERE NOT EXISTS (SELECT 1 FROM recurring.r o WHERE o.pair_id = r.pair_id AND o.node = d.v))
SELECT ends.pair_id, ends.a AS start, ends.b AS "end", CAST(r.dist AS BIGINT) AS dist
FROM ends LEFT JOIN r ON r.pair_id = ends.pair_id AND r.node = ends.b
""")
def shortest_path_len(spark, sf_dir):
    """Hops between the first and the last billed order of each nation."""
    billed = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    when = F.struct("o_orderdate", "o_orderkey")
    pairs = (load(spark, sf_dir, "orders").join(billed, "o_orderkey", "left_semi")
             .join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
             .groupBy(F.col("c_nationkey").alias("pair_id"))
             .agg((F.min_by("o_orderkey", when) * 2).alias("start"), (F.max_by("o_orderkey", when) * 2).alias("end")))
    return G.shortest_path_len(order_part_edges(spark, sf_dir), pairs)


@register("reachable_subgraph", f"""
WITH RECURSIVE {_EDGES},
seed AS (SELECT min(a) AS s FROM e),
r(node) AS (SELECT s FROM seed UNION SELECT d.v FROM r JOIN d ON d.u = r.node),
top AS (SELECT greatest(max(a), max(b)) + 1 AS base FROM e),
ids AS (SELECT node, row_number() OVER (ORDER BY node) - 1 + (SELECT base FROM top) AS new_id FROM r)
SELECT e.a AS old_src, e.b AS old_dst, x.new_id AS new_src, y.new_id AS new_dst
FROM e JOIN ids x ON e.a = x.node JOIN ids y ON e.b = y.node
""")
def reachable_subgraph(spark, sf_dir):
    e = order_part_edges(spark, sf_dir)
    seed = e.agg(F.min("src")).first()[0]
    return G.reachable_subgraph(e, seed)


def event_grid(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    cells = ev.groupBy(F.col("event_type").alias("grid_id"), F.dayofmonth("ts").alias("r"),
                       F.hour("ts").alias("c")).agg(F.count(F.lit(1)).alias("cnt"))
    mean = cells.groupBy("grid_id").agg(F.avg("cnt").alias("_m"))
    return cells.join(mean, "grid_id").withColumn("land", F.col("cnt") > F.col("_m"))


@register("count_islands", """
WITH RECURSIVE cells AS (SELECT event_type AS g, dayofmonth(ts) AS r, hour(ts) AS c, count(*) AS cnt
                         FROM events GROUP BY 1, 2, 3),
land AS (SELECT c1.* FROM cells c1 JOIN (SELECT g, avg(cnt) AS m FROM cells GROUP BY g) a USING (g) WHERE cnt > m),
adj AS (SELECT a.g, a.r, a.c, b.r AS r2, b.c AS c2 FROM land a JOIN land b
          ON a.g = b.g AND ((a.r = b.r AND abs(a.c - b.c) = 1) OR (a.c = b.c AND abs(a.r - b.r) = 1))),
lab(g, r, c, lr, lc) AS (SELECT g, r, c, r, c FROM land
                         UNION SELECT adj.g, adj.r2, adj.c2, lab.lr, lab.lc FROM lab JOIN adj
                           ON adj.g = lab.g AND adj.r = lab.r AND adj.c = lab.c),
comp AS (SELECT g, r, c, min(lr * 100 + lc) AS k FROM lab GROUP BY g, r, c)
SELECT g AS grid_id, CAST(count(DISTINCT k) AS BIGINT) AS islands FROM comp GROUP BY g
UNION ALL
SELECT DISTINCT g, CAST(0 AS BIGINT) FROM cells WHERE g NOT IN (SELECT g FROM land)
""")
def count_islands(spark, sf_dir):
    return G.count_islands(event_grid(spark, sf_dir))


def supply_graph(spark, sf_dir, cyclic: bool = False):
    li = load(spark, sf_dir, "lineitem")
    nodes = (load(spark, sf_dir, "orders").select((F.col("o_orderkey") * 3).alias("node"))
             .unionByName(load(spark, sf_dir, "part").select((F.col("p_partkey") * 3 + 1).alias("node")))
             .unionByName(load(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3 + 2).alias("node"))))
    edges = (li.select((F.col("l_orderkey") * 3).alias("src"), (F.col("l_partkey") * 3 + 1).alias("dst"))
               .unionByName(li.select((F.col("l_partkey") * 3 + 1).alias("src"), (F.col("l_suppkey") * 3 + 2).alias("dst"))))
    if cyclic:
        edges = edges.unionByName(li.filter(F.col("l_linenumber") == 1)
                                    .select((F.col("l_suppkey") * 3 + 2).alias("src"), (F.col("l_orderkey") * 3).alias("dst")))
    return nodes.distinct(), edges.distinct()


@register("topo_levels", """
WITH RECURSIVE nodes AS (SELECT o_orderkey * 3 AS node FROM orders UNION SELECT p_partkey * 3 + 1 FROM part
                         UNION SELECT s_suppkey * 3 + 2 FROM supplier),
e AS (SELECT DISTINCT l_orderkey * 3 AS src, l_partkey * 3 + 1 AS dst FROM lineitem
      UNION SELECT DISTINCT l_partkey * 3 + 1, l_suppkey * 3 + 2 FROM lineitem),
dep(node, depth) AS (SELECT node, 0 FROM nodes WHERE node NOT IN (SELECT dst FROM e)
                     UNION SELECT e.dst, dep.depth + 1 FROM dep JOIN e ON e.src = dep.node)
SELECT node, CAST(max(depth) AS BIGINT) AS level, false AS has_cycle FROM dep GROUP BY node
""")
def topo_levels(spark, sf_dir):
    n, e = supply_graph(spark, sf_dir)
    return G.topo_levels(n, e)


# Every path without a cycle has at most three nodes here (order, part, supplier), so a node that a longer walk
# reaches lies on or after a cycle.
@register("topo_levels_cyclic", """
WITH RECURSIVE nodes AS (SELECT o_orderkey * 3 AS node FROM orders UNION SELECT p_partkey * 3 + 1 FROM part
                         UNION SELECT s_suppkey * 3 + 2 FROM supplier),
e AS (SELECT DISTINCT l_orderkey * 3 AS src, l_partkey * 3 + 1 AS dst FROM lineitem
      UNION SELECT DISTINCT l_partkey * 3 + 1, l_suppkey * 3 + 2 FROM lineitem
      UNION SELECT DISTINCT l_suppkey * 3 + 2, l_orderkey * 3 FROM lineitem WHERE l_linenumber = 1),
walk(node, depth) AS (SELECT node, 0 FROM nodes UNION SELECT e.dst, walk.depth + 1 FROM walk JOIN e ON e.src = walk.node WHERE depth < 4),
deep AS (SELECT node, max(depth) AS level FROM walk GROUP BY node)
SELECT node, CASE WHEN level < 4 THEN CAST(level AS BIGINT) END AS level, (SELECT max(level) >= 4 FROM deep) AS has_cycle FROM deep
""")
def topo_levels_cyclic(spark, sf_dir):
    n, e = supply_graph(spark, sf_dir, cyclic=True)
    return G.topo_levels(n, e)


# --- hierarchy -------------------------------------------------------------------

def hierarchy(spark, sf_dir, billed_only: bool = False):
    """Nodes (tree_id, node_id, parent_id, ord, val) of the region forest."""
    r = load(spark, sf_dir, "region")
    n = load(spark, sf_dir, "nation")
    c = load(spark, sf_dir, "customer")
    o = load(spark, sf_dir, "orders")
    if billed_only:
        o = o.join(load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey",
                   "left_semi")
    k = F.lit(KIND)
    rows = (r.select(F.col("r_regionkey").cast("bigint").alias("node_id"), F.lit(None).cast("bigint").alias("parent_id"),
                     F.col("r_regionkey").cast("bigint").alias("ord"), F.col("r_name").alias("val"))
             .unionByName(n.select((k + F.col("n_nationkey")).alias("node_id"), F.col("n_regionkey").cast("bigint").alias("parent_id"),
                                   F.col("n_nationkey").cast("bigint").alias("ord"), F.col("n_name").alias("val")))
             .unionByName(c.select((k * 2 + F.col("c_custkey")).alias("node_id"), (k + F.col("c_nationkey")).alias("parent_id"),
                                   F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("val")))
             .unionByName(o.select((k * 3 + F.col("o_orderkey")).alias("node_id"), (k * 2 + F.col("o_custkey")).alias("parent_id"),
                                   F.col("o_orderkey").alias("ord"), F.col("o_orderstatus").alias("val"))))
    return rows


def with_tree(spark, sf_dir, rows):
    """Attach tree_id (= region key) by walking from the roots."""
    r = TR.roots(rows)
    # orphans (a parent that does not exist) are not part of any tree
    real = rows.filter(F.col("parent_id").isNull()).select(F.col("node_id").alias("root"))
    r = r.join(real, "root", "left_semi")
    return rows.join(r, "node_id").withColumnRenamed("root", "tree_id")


@register("level_order", f"""
WITH n AS (SELECT n_regionkey AS t, n_nationkey,
                  row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos
           FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT n.t, c_custkey, row_number() OVER (PARTITION BY n.t ORDER BY n.pos, c_custkey) - 1 AS pos
      FROM customer JOIN n ON c_nationkey = n.n_nationkey),
o AS (SELECT c.t, o_orderkey, row_number() OVER (PARTITION BY c.t ORDER BY c.pos, o_orderkey) - 1 AS pos
      FROM orders JOIN c ON o_custkey = c.c_custkey)
SELECT CAST(r_regionkey AS BIGINT) AS tree_id, CAST(0 AS BIGINT) AS depth, CAST(0 AS BIGINT) AS pos,
       CAST(r_regionkey AS BIGINT) AS node_id FROM region
UNION ALL SELECT t, 1, pos, {KIND} + n_nationkey FROM n
UNION ALL SELECT t, 2, pos, {2 * KIND} + c_custkey FROM c
UNION ALL SELECT t, 3, pos, {3 * KIND} + o_orderkey FROM o
""")
def level_order(spark, sf_dir):
    rows = with_tree(spark, sf_dir, hierarchy(spark, sf_dir))
    return TR.level_order(rows, "tree_id", "node_id", "parent_id", "ord")


@register("lca", f"""
WITH ch AS (SELECT o_orderkey, c_custkey, n_nationkey, r_regionkey
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                        JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT a.o_orderkey AS ka, b.o_orderkey AS kb FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1)
SELECT CAST(x.r_regionkey AS BIGINT) AS tree_id, {3 * KIND} + p.ka AS a, {3 * KIND} + p.kb AS b,
       CASE WHEN y.o_orderkey IS NULL THEN NULL
            WHEN x.c_custkey = y.c_custkey THEN {2 * KIND} + x.c_custkey
            WHEN x.n_nationkey = y.n_nationkey THEN {KIND} + x.n_nationkey
            WHEN x.r_regionkey = y.r_regionkey THEN CAST(x.r_regionkey AS BIGINT) END AS lca
FROM p JOIN ch x ON x.o_orderkey = p.ka LEFT JOIN ch y ON y.o_orderkey = p.kb
""")
def lca(spark, sf_dir):
    rows = with_tree(spark, sf_dir, hierarchy(spark, sf_dir))
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    pairs = o.join(o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_orderkey").alias("kb")), "o_orderkey") \
        .select((F.lit(3 * KIND) + F.col("o_orderkey")).alias("a"), (F.lit(3 * KIND) + F.col("kb")).alias("b"))
    pairs = pairs.join(rows.select(F.col("node_id").alias("a"), "tree_id"), "a")
    return TR.lca(rows, pairs).select("tree_id", "a", "b", "lca")


def heap_trees(spark, sf_dir, val: str):
    p = load(spark, sf_dir, "part").select(F.col("p_brand").alias("tree_id"), "p_partkey", "p_retailprice")
    h = running(p, "tree_id", ["p_partkey"], {"i": ("count", "i")})
    return h.select("tree_id", F.col("i").alias("node_id"),
                    F.when(F.col("i") > 1, F.expr("i div 2")).alias("parent_id"),
                    (F.col("i") % 2).cast("int").alias("side"), F.col(val).alias("val"))


_HEAP = "h AS (SELECT p_brand AS tree_id, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i FROM part)"


@register("validate_ordered_tree", f"""
WITH RECURSIVE {_HEAP},
r(tree_id, i, val, lo, hi) AS (
    SELECT tree_id, i, p_retailprice, NULL::DOUBLE, NULL::DOUBLE FROM h WHERE i = 1
    UNION ALL
    SELECT c.tree_id, c.i, c.p_retailprice,
           CASE WHEN c.i % 2 = 1 THEN r.val ELSE r.lo END, CASE WHEN c.i % 2 = 0 THEN r.val ELSE r.hi END
    FROM r JOIN h c ON c.tree_id = r.tree_id AND c.i IN (2 * r.i, 2 * r.i + 1))
SELECT tree_id, bool_and((lo IS NULL OR val > lo) AND (hi IS NULL OR val < hi)) AS valid FROM r GROUP BY tree_id
""")
def validate_ordered_tree(spark, sf_dir):
    return TR.validate_ordered_tree(heap_trees(spark, sf_dir, "p_retailprice"))


@register("encode_trees", f"""
WITH {_HEAP}
SELECT tree_id, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY i) AS data FROM h GROUP BY tree_id
""")
def encode_trees(spark, sf_dir):
    return TR.encode_trees(heap_trees(spark, sf_dir, "p_partkey"))


@register("decode_trees", f"""
WITH {_HEAP}
SELECT tree_id, i - 1 AS node_id, CASE WHEN i > 1 THEN i // 2 - 1 END AS parent_id,
       CASE WHEN i > 1 THEN CAST(i % 2 AS INTEGER) END AS side, CAST(p_partkey AS VARCHAR) AS val
FROM h
""")
def decode_trees(spark, sf_dir):
    return TR.decode_trees(TR.encode_trees(heap_trees(spark, sf_dir, "p_partkey")))


@register("hierarchy_diff", f"""
WITH c AS (SELECT c_nationkey AS t, c_custkey, c_mktsegment,
                  CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS VARCHAR) AS o
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
oa AS (SELECT o_custkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS VARCHAR) AS o
       FROM orders),
ob AS (SELECT o_custkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS VARCHAR) AS o
       FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
n AS (SELECT n_regionkey AS t, n_nationkey, n_name,
             CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS VARCHAR) AS o
      FROM nation JOIN region ON n_regionkey = r_regionkey),
pa AS (SELECT CAST(r_regionkey AS BIGINT) AS tree_id, '0' AS path, r_name AS v FROM region
       UNION ALL SELECT t, '0/' || o, n_name FROM n
       UNION ALL SELECT n.t, '0/' || n.o || '/' || c.o, c_mktsegment FROM c JOIN n ON c.t = n.n_nationkey
       UNION ALL SELECT n.t, '0/' || n.o || '/' || c.o || '/' || oa.o, o_orderstatus
                 FROM oa JOIN c ON oa.o_custkey = c.c_custkey JOIN n ON c.t = n.n_nationkey),
pb AS (SELECT CAST(r_regionkey AS BIGINT) AS tree_id, '0' AS path, r_name AS v FROM region
       UNION ALL SELECT t, '0/' || o, n_name FROM n
       UNION ALL SELECT n.t, '0/' || n.o || '/' || c.o, c_mktsegment FROM c JOIN n ON c.t = n.n_nationkey
       UNION ALL SELECT n.t, '0/' || n.o || '/' || c.o || '/' || ob.o, o_orderstatus
                 FROM ob JOIN c ON ob.o_custkey = c.c_custkey JOIN n ON c.t = n.n_nationkey)
SELECT coalesce(pa.tree_id, pb.tree_id) AS tree_id, coalesce(pa.path, pb.path) AS path, pa.v AS val_a, pb.v AS val_b
FROM pa FULL JOIN pb ON pa.tree_id = pb.tree_id AND pa.path = pb.path
WHERE pa.v IS DISTINCT FROM pb.v
""")
def hierarchy_diff(spark, sf_dir):
    a = with_tree(spark, sf_dir, hierarchy(spark, sf_dir))
    b = with_tree(spark, sf_dir, hierarchy(spark, sf_dir, billed_only=True))
    return TR.hierarchy_diff(a, b).select("tree_id", "path", "val_a", "val_b")


# --- text ----------------------------------------------------------------------------

def doc_tokens(spark, sf_dir):
    return TX.tokens(load(spark, sf_dir, "documents"), "text", keep=["doc_id"])


def bench_tokens(spark, sf_dir):
    return TX.tokens(load(spark, sf_dir, "benchmark"), "text")


_TOK = r"""tok AS (SELECT doc_id, lower(w) AS word FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\P{L}+')) AS w
                                                FROM documents) t WHERE w <> ''),
voc AS (SELECT DISTINCT word FROM tok),
dict AS (SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(regexp_split_to_array(text, '\P{L}+')) AS w FROM benchmark) t
         WHERE w <> '')"""


@register("group_anagrams", f"""
WITH {_TOK},
k AS (SELECT word, array_to_string(list_sort(string_split(word, '')), '') AS anagram_key FROM voc)
SELECT anagram_key, word, count(*) OVER (PARTITION BY anagram_key) AS group_size FROM k
""")
def group_anagrams(spark, sf_dir):
    return TX.group_anagrams(doc_tokens(spark, sf_dir)).select("anagram_key", "word", "group_size")


@register("fuzzy_join", f"""
WITH {_TOK},
dels AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM voc, range(1, length(word) + 1) t(i)),
near AS (SELECT a.word AS a, b.word AS b FROM dels a JOIN dels b ON a.rest = b.rest AND a.i = b.i
         UNION SELECT dels.word, voc.word FROM dels JOIN voc ON dels.rest = voc.word
         UNION SELECT voc.word, dels.word FROM dels JOIN voc ON dels.rest = voc.word)
SELECT DISTINCT a, b, 1 AS dist FROM near WHERE a < b
""")
def fuzzy_join(spark, sf_dir):
    return TX.fuzzy_join(doc_tokens(spark, sf_dir), None, 1)


@register("segmentable", f"""
WITH RECURSIVE {_TOK},
r(word, pos) AS (SELECT word, 0 FROM voc
                 UNION SELECT r.word, r.pos + length(dict.word) FROM r JOIN dict
                   ON substr(r.word, r.pos + 1, length(dict.word)) = dict.word)
SELECT voc.word AS text, coalesce(bool_or(r.pos = length(voc.word)), false) AS segmentable
FROM voc LEFT JOIN r ON r.word = voc.word GROUP BY voc.word
""")
def segmentable(spark, sf_dir):
    texts = doc_tokens(spark, sf_dir).select(F.col("word").alias("text")).distinct()
    return TX.segmentable(texts, bench_tokens(spark, sf_dir))


@register("membership", f"""
WITH {_TOK}
SELECT DISTINCT word FROM voc WHERE word IN (SELECT word FROM dict)
""")
def membership(spark, sf_dir):
    voc = doc_tokens(spark, sf_dir).select("word").distinct()
    return ST.membership(voc, bench_tokens(spark, sf_dir), "word")


@register("word_ladder", r"""
WITH RECURSIVE tok AS (SELECT doc_id, i, lower(w) AS word FROM (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT doc_id, regexp_split_to_array(text, '\P{L}+') AS ws FROM documents) s) t WHERE w <> ''),
voc AS (SELECT DISTINCT word FROM tok),
pairs AS (SELECT doc_id AS pair_id, arg_min(word, i) AS b, arg_max(word, i) AS e FROM tok GROUP BY doc_id),
pat AS (SELECT word, substr(word, 1, k - 1) || '*' || substr(word, k + 1) AS p
        FROM (SELECT word, unnest(generate_series(1, length(word))) AS k FROM voc) s),
near AS (SELECT x.word AS a, y.word AS b FROM pat x JOIN pat y ON x.p = y.p AND x.word <> y.word),
reach(b, word, d) USING KEY (b, word) AS (
    SELECT DISTINCT b, b, 0 FROM pairs WHERE length(b) = length(e)
    UNION
    SELECT reach.b, near.b, min(reach.d) + 1 FROM reach JOIN near ON reach.word = near.a
    WHERE NOT EXISTS (SELECT 1 FROM recurring.reach AS old WHERE old.b = reach.b AND old.word = near.b)
    GROUP BY reach.b, near.b)
SELECT pair_id, pairs.b AS "begin", pairs.e AS "end", CAST(coalesce(d + 1, 0) AS INTEGER) AS ladder_len
FROM pairs LEFT JOIN reach ON reach.b = pairs.b AND reach.word = pairs.e
""")
def word_ladder(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    # the first and the last token of each document; of different lengths, the answer is 0
    pairs = TX.end_tokens(docs, "doc_id", "text", "begin", "end").withColumnRenamed("doc_id", "pair_id")
    return TX.word_ladder(TX.tokens(docs, "text"), pairs)


_TAGS = """tags AS (
  SELECT page_id, pos, lower(regexp_extract(t, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS tag, starts_with(t, '</') AS is_close,
         ends_with(t, '/>') AS self
  FROM (SELECT page_id, generate_subscripts(ts, 1) - 1 AS pos, unnest(ts) AS t FROM (
          SELECT page_id, regexp_extract_all(
                   regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                                                 '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'),
                                  '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g'),
                   '</?[A-Za-z][A-Za-z0-9]*[^>]*>') AS ts
          FROM pages) a) b),
tk AS (SELECT * FROM tags WHERE tag NOT IN ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta',
                                            'param', 'source', 'track', 'wbr') AND NOT self),
dep AS (SELECT *, sum(CASE WHEN is_close THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS depth
        FROM tk),
lv AS (SELECT *, CASE WHEN is_close THEN depth + 1 ELSE depth END AS level FROM dep),
pr AS (SELECT *, lag(tag) OVER (PARTITION BY page_id, level ORDER BY pos) AS ptag,
              lag(is_close) OVER (PARTITION BY page_id, level ORDER BY pos) AS pclose FROM lv)"""


@register("nesting_valid", f"""
WITH {_TAGS},
agg AS (SELECT page_id, min(depth) AS mind, arg_max(depth, pos) AS enddepth,
               max(CASE WHEN is_close AND (ptag IS NULL OR pclose OR ptag <> tag) THEN 1 ELSE 0 END) AS bad,
               count(*) AS n_tokens FROM pr GROUP BY page_id)
SELECT pages.page_id, coalesce(mind >= 0 AND enddepth = 0 AND bad = 0, true) AS valid,
       coalesce(n_tokens, 0) AS n_tokens
FROM pages LEFT JOIN agg USING (page_id)
""")
def nesting_valid(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    t = TX.html_tags(pages, "page_id", "html")
    v = TX.nesting_valid(t, "page_id", "pos", "tag")
    return (pages.select("page_id").join(v, "page_id", "left")
                 .select("page_id", F.coalesce("valid", F.lit(True)).alias("valid"),
                         F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens")))
