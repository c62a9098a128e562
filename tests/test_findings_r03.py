"""What the findings of the third round asked for, on rows of their own."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from eventide.llm import urlrules as U
from eventide.operators import ml as M
from eventide.operators import ratelimit as RL
from eventide.operators import slots as SL
from eventide.streaming import operators as SO
from eventide.streaming import runtime as RT

T0 = dt.datetime(2024, 1, 1)
EVENTS = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double, props string"


def written(spark, root, **tables):
    """The folder of small tables: name=(rows, schema)."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_the_days_of_a_slot_replay_fill_up(spark, tmp_path):
    # 40 users of one doctor ask on one day: 32 slots, 8 conflicts; one slot comes free and is booked again
    rows = [(i, 3 * i, T0 + dt.timedelta(minutes=i), "view", 1.0, '{"k": 1}') for i in range(40)]
    rows += [(40, 3, T0 + dt.timedelta(hours=2), "error", 1.0, '{"k": 39}'), (41, 6, T0 + dt.timedelta(hours=3), "click", 1.0, '{"k": 1}')]
    d = written(spark, tmp_path, events=(rows, EVENTS))
    got = {r.event_id: (r.doctor_id, r.status, r.result_slot) for r in E.queries()["slots_with_cancels"](spark, d).collect()}
    want = {i: (0, "ok", i) if i < 32 else (0, "conflict", None) for i in range(40)}
    assert got == want | {40: (0, "ok", 5), 41: (0, "ok", 5)}


def stream_run(spark, df, build):
    """Rows of a stream over ``df`` and the most states it held after a batch."""
    root, out = RT.scratch(spark, "f-in"), RT.scratch(spark, "f-out")
    files = RT.stage_by_time(df, "ts", root)
    s = build(SO.event_time(RT.file_stream(spark, root, df.schema, files), "ts", "1 second"))
    q = s.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.schema(s.schema).parquet(f"{out}/data"), max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"])


def requests(seed):
    """600 rows of 60 keys, one of them null, within 200 seconds."""
    r = random.Random(seed)
    keys = [None, *(f"k{i}" for i in range(59))]
    return [(i, r.choice(keys), T0 + dt.timedelta(seconds=r.randint(0, 200)), float(r.randint(1, 9)), r.choice([0, 1, 1, 2])) for i in range(600)]


@pytest.mark.parametrize("kind", ["slots", "bucket", "sliding"])
def test_keys_of_a_group_share_a_state(spark, monkeypatch, kind):
    monkeypatch.setattr(SO, "GROUPS", 4)
    monkeypatch.setattr(SO, "DAY_GROUPS", 4)
    df = spark.createDataFrame(requests(3), "i int, c string, ts timestamp, v double, permits int")
    if kind == "slots":
        df = df.withColumn("day", F.to_date("ts")).withColumn("op", F.when(F.col("permits") == 2, "cancel").otherwise("book")) \
            .withColumn("slot", F.when(F.col("permits") == 2, F.col("v").cast("bigint")))
        got, states = stream_run(spark, df, lambda s: SO.slots_stream(s, "c", "day", "ts", "i", n_slots=6, carry=["i"]))
        want, cols = SL.slots_with_cancels(df, "c", "day", ["ts", "i"], n_slots=6), ["status", "result_slot"]
        assert {"ok", "conflict", "bad_request", "not_found"} == {x.status for x in got.collect()}
    elif kind == "bucket":
        args = {"rate": 0.1, "capacity": 3.0, "tie": "i"}
        got, states = stream_run(spark, df, lambda s: SO.token_bucket_stream(s, "c", "ts", "permits", **args, carry=["i"]))
        want, cols = RL.token_bucket(df, "c", "ts", "permits", **args), ["allowed", "remaining", "reset_seconds"]
    else:
        got, states = stream_run(spark, df, lambda s: SO.sliding_velocity(s, "c", "ts", "v", 30, carry=["i"]))
        rows = requests(3)
        want, cols = spark.createDataFrame([(a[0], len(w), sum(w)) for a in rows for w in [[
            b[3] for b in rows if b[1] == a[1] and dt.timedelta(0) <= a[2] - b[2] <= dt.timedelta(seconds=30)]]],
            "i int, trailing_count bigint, trailing_amount_sum double"), ["trailing_count", "trailing_amount_sum"]
    # a row later than its batch's own time is counted when it comes: slices are in the order of time, so none is
    assert sorted(map(tuple, got.select("i", *cols).collect())) == sorted(map(tuple, want.select("i", *cols).collect()))
    assert states <= 5  # four groups and the null key's, not sixty


def test_a_step_reads_its_own_rows_alone(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def vector(i):
        read.add(1)
        return [float((i * j) % 7) for j in range(1, 30)]

    rows = spark.range(40).select(vector("id").alias("scaled"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    _, history = M.train_mlp(rows, epochs=2, batch_rows=5, workers=1)
    assert [h["rows"] for h in history] == [40, 40]
    assert read.value <= 40 * 4  # an epoch reads the rows once, not once in each of its eight steps


def far_urls():
    """Twenty segments each, in one order: blocked if the first, the last and three between meet, in rows that differ elsewhere."""
    r = random.Random(5)
    marks, urls, bad = (0, 4, 9, 14, 19), [], []
    for i in range(400):
        w = i % 20 == 0
        some = set(marks) if w else set(r.sample(marks, r.randint(0, 4)))
        if not w and i % 2:  # any four of the five are no reason
            some = set(marks) - {r.choice(marks)}
        urls.append("http://h/" + "/".join(f"s{chr(97 + j)}{'y' if j in some else 'n'}" if j in marks else f"s{chr(97 + j)}" for j in range(20)))
        bad.append(w)
    return urls, bad


def test_items_far_apart_and_many_make_a_rule(spark):
    urls, bad = far_urls()
    pages = spark.createDataFrame([*enumerate(urls)], "page_id bigint, url string")
    labels = spark.createDataFrame([*enumerate(bad)], "doc_id bigint, b boolean")
    got = {x.page_id: x.verdict == "block" for x in U.judge(pages, labels, []).collect()}
    assert got == dict(enumerate(bad))


def partitions_while_writing(spark, monkeypatch, run):
    """The result of ``run`` and the numbers of partitions in force while the operators wrote, where a partition takes ten rows."""
    from eventide import session as S
    from eventide.operators import graphs as G

    seen, keys = [], ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k) for k in keys]
    monkeypatch.setattr(S, "TASK_ROWS", 10)
    monkeypatch.setattr(G, "staged", lambda df: seen.append([int(spark.conf.get(k).rstrip("b")) for k in keys]) or S.staged(df))
    got = run(G).collect()
    assert [spark.conf.get(k) for k in keys] == before
    assert all(a <= 16 << 20 and b <= 8 << 20 for _, a, b in seen)
    return got, {n for n, _, _ in seen}


def chain(spark, n=1200):
    return spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))


def test_partitions_grow_with_the_edges_of_connected_components(spark, monkeypatch):
    got, parts = partitions_while_writing(spark, monkeypatch, lambda G: G.connected_components(chain(spark)))
    assert {tuple(r) for r in got} == {(i, 0) for i in range(1201)}
    assert 240 in parts  # 2400 directed edges


def test_partitions_grow_with_the_edges_of_shortest_paths(spark, monkeypatch):
    ends = spark.createDataFrame([(1, 3, 9), (2, 0, 5000)], "pair_id int, start bigint, end bigint")
    got, parts = partitions_while_writing(spark, monkeypatch, lambda G: G.shortest_path_len(chain(spark), ends))
    assert {r.pair_id: r.dist for r in got} == {1: 6, 2: None}
    assert 240 in parts


def test_partitions_grow_with_the_edges_of_a_reachable_subgraph(spark, monkeypatch):
    star = spark.range(1, 1201).select(F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"))
    got, parts = partitions_while_writing(spark, monkeypatch, lambda G: G.reachable_subgraph(star, 0))
    assert sorted((r.old_src, r.old_dst, r.new_src, r.new_dst) for r in got) == [(0, i, 1201, 1201 + i) for i in range(1, 1201)]
    assert 240 in parts


def test_a_hierarchy_is_read_once(spark):
    from eventide.operators import trees as TR

    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(v):
        read.add(1)
        return v

    def forest(last):
        rows = [(t, i, (i - 1) // 2 if i else None, i, f"v{i}") for t in (1, None) for i in range(7)]
        df = spark.createDataFrame([*rows, (2, 0, None, 0, "r"), (2, 1, 0, 1, last)], "tree_id int, node_id int, parent_id int, ord int, val string")
        return df.withColumn("val", told("val"))

    got = TR.hierarchy_diff(forest("x"), forest("y")).collect()
    assert [tuple(r) for r in got] == [(2, "0/0", "x", "y")]
    assert read.value == 32


def test_a_slice_has_files_by_its_rows(spark, monkeypatch):
    from eventide.plans import serving as SV

    monkeypatch.setattr(RT, "FILE_ROWS", 100)
    df = spark.range(5000).coalesce(1).select("id", F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"))
    root = RT.scratch(spark, "f-in")
    assert RT.stage_by_time(df, "ts", root) == 10
    files = [r[0] for r in spark.read.option("recursiveFileLookup", "true").parquet(root).select(F.input_file_name()).distinct().collect()]
    assert len(files) == 50 and all(sum(f"slice={i}/" in f for f in files) == 10 for i in range(5))
    assert {r.id for r in spark.read.option("recursiveFileLookup", "true").parquet(root).collect()} == set(range(5000))

    tx = df.select(F.col("id").cast("string").alias("transaction_id"), F.lit("a").alias("account_id"), F.col("ts").alias("timestamp"),
                   F.lit(1.0).alias("amount"), F.lit("view").alias("merchant_category"), F.array(F.lit(1.0)).alias("features"))
    dealt = []
    monkeypatch.setattr(SV, "transactions", lambda spark, sf_dir: tx)
    monkeypatch.setattr(SV, "staged", lambda x: dealt.append(x.rdd.getNumPartitions()) or x)
    SV.record_stream(spark, None, "f-rec")
    assert dealt == [50]


def test_the_latest_versions_are_hashed_not_sorted(spark):
    df = spark.createDataFrame([(i % 7, T0 + dt.timedelta(hours=i)) for i in range(50)], "k long, ts timestamp")
    root = RT.scratch(spark, "f-in")
    files = RT.stage_by_time(df, "ts", root)
    s = RT.file_stream(spark, root, df.schema, files).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"))
    got = RT.run_update(s, "f-upd", ["k"])
    assert {r.k: (r.n, r.first) for r in got.collect()} == {k: (8 if k == 0 else 7, T0 + dt.timedelta(hours=k)) for k in range(7)}
    assert "SortAggregate" not in got._jdf.queryExecution().toString()


def test_a_round_of_the_hub_search_has_rows_by_nodes_not_by_searches(spark, monkeypatch):
    from eventide import session as S
    from eventide.operators import graphs as G

    n, side = 144, 12  # all words of two letters out of twelve: any two are one or two steps apart
    hubs = spark.range(n).select(F.col("id").alias("node"), F.explode(F.array(F.expr(f"id div {side}"), F.expr(f"100 + id % {side}"))).alias("hub"))
    pairs = [(i, i, j) for i in range(n) for j in ((i + 1) % n, (i + 30) % n, (i + side) % n)] + [(n, 5, 5), (n + 1, 3, 900), (n + 2, None, 4)]
    seen = []

    def kept(df):
        out = S.staged(df)
        if {"origin", "node"} == set(df.columns) or "_bits" in df.columns:
            seen.append(out.count())
        return out

    monkeypatch.setattr(G, "WORDS", 1, raising=False)
    monkeypatch.setattr(G, "staged", kept)
    got = G.pair_distance(None, spark.createDataFrame([(p, a, b) for p, (_, a, b) in enumerate(pairs)], "pair_id int, start bigint, end bigint"), hubs=hubs).collect()
    near = lambda a, b: 1 if a // side == b // side or a % side == b % side else 2
    want = {p: None if a is None or b >= n else 0 if a == b else near(a, b) for p, (_, a, b) in enumerate(pairs)}
    assert {r.pair_id: r.dist for r in got} == want and len(got) == len(pairs)
    assert seen and max(seen) <= n * -(-(n + 2) // 64)  # nodes by blocks of 64, not a row for each search and node


def test_a_ladder_reads_words_and_pairs_once(spark):
    from eventide.operators import text as TX

    reads = {c: spark.sparkContext.accumulator(0) for c in ("word", "begin")}

    def told(c):
        return F.udf(lambda v: reads[c].add(1) or v, "string").asNondeterministic()(c)

    words = spark.createDataFrame([(w,) for w in ["hot", "dot", "dog", "lot", "log", "cog"]], "word string").select(told("word").alias("word"))
    pairs = spark.createDataFrame([(0, "hit", "cog"), (1, "hit", "hit"), (2, "dot", "log")], "pair_id int, begin string, end string").withColumn("begin", told("begin"))
    assert {r.pair_id: r.ladder_len for r in TX.word_ladder(words, pairs).collect()} == {0: 5, 1: 1, 2: 3}
    assert (reads["word"].value, reads["begin"].value) == (6, 3)


def test_the_end_tokens_of_a_text(spark):
    from eventide.operators import text as TX

    texts = ["One two THREE", " a", "b ", "--Ünter, den!", "", " ", "42", None, "x", "Été9"]
    df = spark.createDataFrame([*enumerate(texts), (11, "p q"), (11, "p q"), (None, "Zu 1 Ende ")], "doc_id bigint, text string")
    for d in (df, df.filter("doc_id is null or doc_id < 11")):  # with a repeated key, and without
        rows = TX.end_tokens(d, "doc_id", "text", "begin", "end").collect()
        got = {r.doc_id: (r.begin, r.end) for r in rows}
        t = TX.tokens(d, "text", keep=["doc_id"], pos="_i").groupBy("doc_id").agg(F.min_by("word", "_i"), F.max_by("word", "_i"))
        assert got == {r[0]: (r[1], r[2]) for r in t.collect()} and len(rows) == len(got)
        assert got[3] == ("ünter", "den") and got[None] == ("zu", "ende") and not {4, 5, 6, 7} & set(got)
