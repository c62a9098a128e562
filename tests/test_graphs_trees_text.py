"""Reference cases for graph, tree and text jobs, plus brute-force checks."""

import itertools
import random

from pyspark.sql import functions as F

from eventide.operators import graphs as G
from eventide.operators import text as TX
from eventide.operators import trees as TR

_NODES = "tree_id string, node_id bigint, parent_id bigint, side int, val bigint"


def _binary(spark, tree, spec):
    """spec: list of (node_id, parent_id, side, val)."""
    return spark.createDataFrame([(tree, n, p, s, v) for n, p, s, v in spec], _NODES)


def test_level_order(spark):
    t = _binary(spark, "t", [(3, None, 0, 3), (9, 3, 0, 9), (20, 3, 1, 20), (15, 20, 0, 15), (7, 20, 1, 7)])
    t = t.withColumn("ord", F.col("side"))
    got = {}
    for r in TR.level_order(t, ord_col="ord").collect():
        got.setdefault(r.depth, {})[r.pos] = r.node_id
    assert [[got[d][p] for p in sorted(got[d])] for d in sorted(got)] == [[3], [9, 20], [15, 7]]


def test_lca(spark):
    spec = [(3, None, 0), (5, 3, 0), (1, 3, 1), (6, 5, 0), (2, 5, 1), (0, 1, 0), (8, 1, 1), (7, 2, 0), (4, 2, 1)]
    t = _binary(spark, "t", [(n, p, s, n) for n, p, s in spec])
    pairs = spark.createDataFrame([("t", 5, 1), ("t", 5, 4)], "tree_id string, a bigint, b bigint")
    got = {(r.a, r.b): r.lca for r in TR.lca(t, pairs).collect()}
    assert got == {(5, 1): 3, (5, 4): 5}


def test_validate_ordered_tree(spark):
    a = _binary(spark, "a", [(1, None, 0, 2), (2, 1, 0, 1), (3, 1, 1, 3)])
    b = _binary(spark, "b", [(1, None, 0, 5), (2, 1, 0, 1), (3, 1, 1, 4), (4, 3, 0, 3), (5, 3, 1, 6)])
    got = {r.tree_id: r.valid for r in TR.validate_ordered_tree(a.unionByName(b)).collect()}
    assert got == {"a": True, "b": False}


def test_encode_decode(spark):
    t = _binary(spark, "t", [(1, None, 0, 1), (2, 1, 0, 2), (3, 1, 1, 3), (4, 3, 0, 4), (5, 3, 1, 5)])
    enc = TR.encode_trees(t)
    assert enc.collect()[0]["data"] == "1,2,3,null,null,4,5"
    dec = TR.decode_trees(enc)
    back = {(r.node_id, r.parent_id, r.side, r.val) for r in dec.collect()}
    assert back == {(0, None, None, "1"), (1, 0, 0, "2"), (2, 0, 1, "3"), (3, 2, 0, "4"), (4, 2, 1, "5")}
    again = TR.encode_trees(dec.withColumn("val", F.col("val").cast("bigint")))
    assert again.collect()[0]["data"] == "1,2,3,null,null,4,5"


def test_hierarchy_diff(spark):
    sch = "tree_id string, node_id bigint, parent_id bigint, ord bigint, val bigint"
    a = spark.createDataFrame([("t", 1, None, 0, 1), ("t", 2, 1, 0, 2), ("t", 3, 1, 1, 3)], sch)
    b = spark.createDataFrame([("t", 1, None, 0, 1), ("t", 2, 1, 0, 2), ("t", 3, 1, 1, 99)], sch)
    assert TR.hierarchy_diff(a, a).count() == 0
    d = TR.hierarchy_diff(a, b).collect()
    assert [(r.path, r.val_a, r.val_b) for r in d] == [("0/1", 3, 99)]


def _paths(nodes):
    """{path: value} of [(tree, node, parent, ord, val)], by walking down from the roots."""
    out, kids = {}, {}
    for t, n, p, o, v in nodes:
        kids.setdefault((t, p), []).append((o, n, v))
    todo = [((t, None), t, "") for t in {r[0] for r in nodes}]
    while todo:
        at, t, pre = todo.pop()
        for i, (_, n, v) in enumerate(sorted(kids.get(at, []))):
            out[t, f"{pre}{i}"] = v
            todo.append(((t, n), t, f"{pre}{i}/"))
    return out


def test_hierarchy_diff_of_random_forests(spark):
    rnd = random.Random(11)
    a = []
    for t in range(6):
        size = 60 if t else 200
        for n in range(size):
            # tree 0 is a chain; a lost parent and a cycle hang under no root
            p = None if n == 0 else n - 1 if t == 0 else rnd.randrange(n)
            a.append((t, n, p, rnd.randrange(3), rnd.choice([None, 1, 2])))
        a += [(t, 900, 899, 0, 5), (t, 901, 902, 0, 5), (t, 902, 901, 0, 5)]
    b = [(t, n, p, o, 7 if t == 3 and n == 20 else v) for t, n, p, o, v in a if (t, n) not in {(0, 150), (2, 5), (2, 6)} and t != 5]
    sch = "tree_id int, node_id int, parent_id int, ord int, val int"
    got = {(r.tree_id, r.path): (r.val_a, r.val_b) for r in TR.hierarchy_diff(spark.createDataFrame(a, sch), spark.createDataFrame(b, sch)).collect()}
    pa, pb = _paths(a), _paths(b)
    assert got == {k: (pa.get(k), pb.get(k)) for k in pa.keys() | pb.keys() if k not in pa or k not in pb or pa[k] != pb[k]}


def test_paths_of_a_chain_take_few_jobs(spark):
    chain = spark.range(2000).select(F.lit(1).alias("tree_id"), F.col("id").alias("node_id"),
                                     F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), F.lit(0).alias("ord"))
    group = "paths-of-a-chain"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert TR.paths(chain).agg(F.max(F.length("path"))).first()[0] == 2 * 2000 - 1
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 100
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_topo_levels(spark):
    def run(n, edges):
        nodes = spark.createDataFrame([(i,) for i in range(n)], "node bigint")
        e = spark.createDataFrame(edges, "src bigint, dst bigint")
        return G.topo_levels(nodes, e).collect()

    assert not run(2, [(0, 1)])[0]["has_cycle"]
    assert run(2, [(0, 1), (1, 0)])[0]["has_cycle"]
    r = run(3, [(0, 1), (1, 2), (0, 2)])
    assert not r[0]["has_cycle"] and {x.node: x.level for x in r} == {0: 0, 1: 1, 2: 2}


def _grid(spark, gid, rows):
    return [(gid, r, c, ch == "1") for r, line in enumerate(rows) for c, ch in enumerate(line)]


def test_count_islands(spark):
    cells = _grid(spark, "g1", ["11110", "11010", "11000", "00000"]) + \
        _grid(spark, "g2", ["11000", "11000", "00100", "00011"]) + _grid(spark, "g3", ["000"])
    df = spark.createDataFrame(cells, "grid_id string, r int, c int, land boolean")
    assert {r.grid_id: r.islands for r in G.count_islands(df).collect()} == {"g1": 1, "g2": 3, "g3": 0}


def _components_brute(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for n in nodes:
        comp.setdefault(find(n), []).append(n)
    return {n: min(members) for members in comp.values() for n in members}


def test_connected_components_random(spark):
    rnd = random.Random(5)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(280)]
    nodes = sorted({x for e in edges for x in e})
    want = _components_brute(edges, nodes)
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = {r.node: r.component for r in G.connected_components(df).collect()}
    want = {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert got == want


def test_bfs_and_subgraph(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11)], "src bigint, dst bigint")
    s = spark.createDataFrame([(0, 1)], "source int, node bigint")
    assert {r.node: r.dist for r in G.bfs(e, s).collect()} == {1: 0, 2: 1, 3: 2, 4: 3}
    pairs = spark.createDataFrame([(0, 1, 4), (1, 1, 11), (2, 3, 3)], "pair_id int, start bigint, end bigint")
    assert {r.pair_id: r.dist for r in G.pair_distance(e, pairs).collect()} == {0: 3, 1: None, 2: 0}
    sub = G.reachable_subgraph(e, 1).collect()
    assert sorted((r.old_src, r.old_dst) for r in sub) == [(1, 2), (2, 3), (3, 4)]
    assert {r.new_src for r in sub} | {r.new_dst for r in sub} == {12, 13, 14, 15}
    assert G.reachable_subgraph(e, None).count() == 0


def test_pair_distance_shares_ends(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(45)] + [(7, 7)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def hops(a, b):
        seen, layer, d = {a}, {a}, 0
        while layer:
            if b in layer:
                return d
            layer = {y for x in layer for y in near.get(x, ())} - seen
            seen |= layer
            d += 1
        return None

    # one end in many pairs, pairs both ways round, a repeated pair, an unknown node, a null end
    asked = [(0, b) for b in range(40)] + [(b, 0) for b in range(0, 40, 3)] + [(3, 9), (3, 9), (5, 99)]
    rows = [(i, a, b) for i, (a, b) in enumerate(asked)]
    pairs = spark.createDataFrame([*rows, (-1, None, 3)], "pair_id int, start bigint, end bigint")
    got = {r.pair_id: r.dist for r in G.pair_distance(spark.createDataFrame(edges, "src bigint, dst bigint"), pairs).collect()}
    assert got == {i: hops(a, b) for i, a, b in rows} | {-1: None}


def test_topo_levels_random(spark):
    rng = random.Random(9)
    edges = [(g, *sorted(rng.sample(range(25), 2))) for g in range(4) for _ in range(30)]
    edges += [(3, 20, 4), (1, 6, 6), (0, 77, 3)]  # a way back, an edge to itself, a source that is no node
    nodes = [(g, n) for g in range(4) for n in range(25)]
    want = {}
    for g in range(4):
        todo, level = set(range(25)), 0
        mine = {(a, b) for h, a, b in edges if h == g}
        while ready := {n for n in todo if not any(b == n for _, b in mine)}:
            want |= {(g, n): level for n in ready}
            mine = {(a, b) for a, b in mine if a not in ready}
            todo, level = todo - ready, level + 1
        want |= {(g, n): None for n in todo}
    cyclic = {g for (g, _), level in want.items() if level is None}
    got = G.topo_levels(spark.createDataFrame(nodes, "g int, node int"), spark.createDataFrame(edges, "g int, src int, dst int"), keys="g").collect()
    assert {(r.g, r.node): r.level for r in got} == want and len(got) == len(want)
    assert all(r.has_cycle == (r.g in cyclic) for r in got)


def test_word_ladder(spark):
    words = spark.createDataFrame([(w,) for w in ["hot", "dot", "dog", "lot", "log", "cog"]], "word string")
    pairs = spark.createDataFrame([(0, "hit", "cog"), (1, "hit", "hit")], "pair_id int, begin string, end string")
    assert {r.pair_id: r.ladder_len for r in TX.word_ladder(words, pairs).collect()} == {0: 5, 1: 1}
    words2 = words.filter(F.col("word") != "cog")
    assert TX.word_ladder(words2, pairs.filter("pair_id = 0")).collect()[0]["ladder_len"] == 0


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_fuzzy_join(spark):
    for a, b, d in (("horse", "ros", 3), ("intention", "execution", 5), ("", "abc", 3), ("abc", "abc", 0)):
        assert spark.range(1).select(F.levenshtein(F.lit(a), F.lit(b)).alias("d")).first()["d"] == d
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(150)})
    for k in (1, 2):
        want = {(a, b) for a, b in itertools.combinations(words, 2) if _lev(a, b) <= k}
        df = spark.createDataFrame([(w,) for w in words], "word string")
        got = {(r.a, r.b) for r in TX.fuzzy_join(df, None, k).collect()}
        assert got == {tuple(sorted(p)) for p in want}


def test_segmentable(spark):
    texts = spark.createDataFrame([("leetcode",), ("applepenapple",), ("catsandog",)], "text string")
    d = spark.createDataFrame([(w,) for w in ["leet", "code", "apple", "pen", "cats", "dog", "sand", "and", "cat"]],
                              "word string")
    got = {r.text: r.segmentable for r in TX.segmentable(texts, d).collect()}
    assert got == {"leetcode": True, "applepenapple": True, "catsandog": False}


def _can_cut(text, words):
    ok = [True] + [False] * len(text)
    for e in range(1, len(text) + 1):
        ok[e] = any(ok[e - len(w)] for w in words if len(w) <= e and text[e - len(w):e] == w)
    return ok[-1]


def test_segmentable_against_a_plain_search(spark):
    rnd = random.Random(5)
    words = ["a", "ab", "bba", "cab", "bcc", "éa", "aaaa", "cabbage"]
    texts = ["".join(rnd.choice("abcé") for _ in range(rnd.randrange(9))) for _ in range(200)]
    texts += ["".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40))) for _ in range(60)]
    long = "".join(rnd.choice(words) for _ in range(900))  # over more than one segment
    texts += ["ab" * 512, "ab" * 512 + "a", "a" * 1023 + "cabbage", "a" * 1020 + "cabbage", "a" * 1023 + "cabbag"]
    texts += [long, long[:1500] + "x" + long[1500:], long + "x", "x" + long, "", "a", None, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for some in (words, ["a"], ["ab"]):
        got = [(r.text, r.segmentable) for r in TX.segmentable(df, spark.createDataFrame([(w,) for w in some + [""]], "word string")).collect()]
        assert len(got) == len(set(texts))
        assert dict(got) == {t: None if t is None else _can_cut(t, some) for t in texts}


def test_segmentable_without_words_or_texts(spark):
    none = spark.createDataFrame([], "word string")
    df = spark.createDataFrame([("a",), ("",)], "text string")
    assert {r.text: r.segmentable for r in TX.segmentable(df, none).collect()} == {"a": False, "": True}
    assert TX.segmentable(df.filter("text = 'b'"), df.select(F.col("text").alias("word"))).count() == 0


def test_group_anagrams(spark):
    df = spark.createDataFrame([(w,) for w in ["eat", "tea", "tan", "ate", "nat", "bat", "", "a"]], "word string")
    groups = {}
    for r in TX.group_anagrams(df).collect():
        groups.setdefault(r.anagram_key, set()).add(r.word)
    assert sorted(map(sorted, groups.values())) == sorted(
        [["ate", "eat", "tea"], ["bat"], ["nat", "tan"], [""], ["a"]])


def test_html_tags(spark):
    html = '<!DOCTYPE html><html><head><script>var t="</p>";</script></head><body><p>a<br>b</p></body></html>'
    pages = spark.createDataFrame([(1, html), (2, "<div><p></div></p>")], "page_id int, html string")
    t = TX.html_tags(pages, "page_id", "html")
    assert [r.tag for r in t.filter("page_id = 1").orderBy("pos").collect()] == \
        ["html", "head", "head", "body", "p", "p", "body", "html"]
    v = {r.page_id: r.valid for r in TX.nesting_valid(t, "page_id", "pos", "tag").collect()}
    assert v == {1: True, 2: False}


def test_lca_random_deep(spark):
    rnd = random.Random(9)
    parent = {0: None}
    for v in range(1, 300):  # long chains: parent is one of the last few nodes
        parent[v] = rnd.randint(max(0, v - 3), v - 1)
    parent[1000] = None  # a second tree
    parent[1001] = 1000
    rows = [("t", v, p, 0, v) for v, p in parent.items()]
    t = spark.createDataFrame(rows, _NODES)

    def anc(v):
        out = []
        while v is not None:
            out.append(v)
            v = parent[v]
        return out

    pairs = [(rnd.randint(0, 299), rnd.randint(0, 299)) for _ in range(60)] + [(5, 1001), (7, 7), (5, 4242)]
    want = {}
    for a, b in pairs:
        if a not in parent or b not in parent:
            want[(a, b)] = None
            continue
        sa = set(anc(a))
        want[(a, b)] = next((x for x in anc(b) if x in sa), None)
    pdf = spark.createDataFrame([("t", a, b) for a, b in pairs], "tree_id string, a bigint, b bigint")
    got = {(r.a, r.b): r.lca for r in TR.lca(t, pdf).collect()}
    assert got == want


def test_validate_random(spark):
    rnd = random.Random(4)
    trees, want = [], {}
    for t in range(30):
        vals = rnd.sample(range(100), rnd.randint(1, 25))
        nodes, root = {}, None  # build a BST by insertion, then maybe corrupt one value
        for i, x in enumerate(vals):
            nodes[i] = [x, None, 0]
            if root is None:
                root = i
                continue
            cur = root
            while True:
                s_ = 0 if x < nodes[cur][0] else 1
                child = next((c for c, (_, p, sd) in nodes.items() if p == cur and sd == s_ and c != i), None)
                if child is None:
                    nodes[i][1], nodes[i][2] = cur, s_
                    break
                cur = child
        if rnd.random() < 0.5 and len(nodes) > 2:
            nodes[rnd.randrange(len(nodes))][0] = rnd.randint(0, 99)

        def ok(n, lo, hi):
            v = nodes[n][0]
            if (lo is not None and v <= lo) or (hi is not None and v >= hi):
                return False
            kids = [(c, sd) for c, (_, p, sd) in nodes.items() if p == n]
            return all(ok(c, v if sd else lo, hi if sd else v) for c, sd in kids)
        want[f"t{t}"] = ok(root, None, None)
        trees += [(f"t{t}", i, p, sd, v) for i, (v, p, sd) in nodes.items()]
    df = spark.createDataFrame(trees, _NODES)
    assert {r.tree_id: r.valid for r in TR.validate_ordered_tree(df).collect()} == want


def test_islands_on_wide_grids(spark):
    """Cells whose coordinates only differ beyond 21 bits stay apart."""
    far = 1 << 21
    cells = spark.createDataFrame([("g", 0, 0, True), ("g", 0, far, True), ("g", 1, 0, True), ("g", far, 5, True), ("h", 0, 0, False)],
                                  "grid_id string, r int, c int, land boolean")
    assert {r.grid_id: r.islands for r in G.count_islands(cells).collect()} == {"g": 3, "h": 0}


def test_reachable_subgraph_of_no_edges(spark):
    e = spark.createDataFrame([], "src bigint, dst bigint")
    assert G.reachable_subgraph(e, 5).count() == 0


def test_components_of_a_star(spark):
    e = spark.range(1, 20001).select(F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"))
    got = G.connected_components(e).agg(F.count_distinct("component").alias("n"), F.count("*").alias("m")).first()
    assert (got.n, got.m) == (1, 20001)


def test_reconcile_without_workers(spark):
    from eventide.operators import jobs as J
    want = spark.createDataFrame([("a", 0), ("b", 1)], "job string, worker_count int")
    seen = spark.createDataFrame([("b", 0, 0, 0, 1, 7)], "job string, rank int, succeeded int, failed int, active int, last_checkpoint_epoch int")
    got = [(r.job, r.rank, r.last_checkpoint_epoch) for r in J.reconcile(want, seen).collect()]
    assert got == [("b", 0, 7)]


def test_word_ladder_begins_outside_the_list(spark):
    """A begin word that is not in the list is no stepping stone for another pair."""
    words = spark.createDataFrame([("abb",), ("aac",)], "word string")
    pairs = spark.createDataFrame([(1, "aab", "aac"), (2, "aaa", "abb"), (3, "aac", "aac"), (4, "abc", "abcd"), (5, "acb", "abb")],
                                  "pair_id int, begin string, end string")
    got = {r.pair_id: r.ladder_len for r in TX.word_ladder(words, pairs).collect()}
    assert got == {1: 2, 2: 0, 3: 1, 4: 0, 5: 2}
    alone = {r.pair_id: r.ladder_len for r in TX.word_ladder(words, pairs.filter("pair_id = 2")).collect()}
    assert alone == {2: 0}


def test_word_ladder_random(spark):
    r = random.Random(8)
    words = sorted({"".join(r.choice("abé") for _ in range(4)) for _ in range(30)})
    pairs = [(i, "".join(r.choice("abé") for _ in range(4)), r.choice(words)) for i in range(40)]

    def steps(a, b):
        if a == b:
            return 1
        seen, layer, n = {a}, [a], 1
        while layer:
            n += 1
            layer = [w for w in words if w not in seen and any(sum(x != y for x, y in zip(w, v)) == 1 for v in layer)]
            if b in layer:
                return n
            seen |= set(layer)
        return 0

    got = TX.word_ladder(spark.createDataFrame([(w,) for w in words], "word string"),
                         spark.createDataFrame(pairs, "pair_id int, begin string, end string"))
    assert {x.pair_id: x.ladder_len for x in got.collect()} == {i: steps(a, b) for i, a, b in pairs}
