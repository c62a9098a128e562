"""Text and token operators: anagram groups, fuzzy matching, word break,
word ladders and tag nesting.  Whole texts are tokenized; nothing is cut
to a prefix."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cols
from ..session import drop_staged, staged
from .graphs import connected_components, pair_distance
from .scan import checked_broadcast, running

# HTML void elements (never closed), per the HTML standard.
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr")
# Raw-text elements whose content is not markup.
RAW_TEXT = ("script", "style")
TOKEN_SPLIT, TOKEN = r"\P{L}+", r"\p{L}+"
SEGMENT = 1024  # characters of a text that are looked up from one string


def tokens(df: DataFrame, text: str, keep=(), out: str = "word", pos: str | None = None) -> DataFrame:
    """Lower-case letter tokens of every text (letters of any script), one row
    each; with ``pos`` also the token's position in its text."""
    parts = F.split(F.col(text), TOKEN_SPLIT)
    if pos:
        t = df.select(*cols(keep), F.posexplode(parts).alias(pos, out))
    else:
        t = df.select(*cols(keep), F.explode(parts).alias(out))
    return t.filter(F.col(out) != "").withColumn(out, F.lower(out))


def end_tokens(df: DataFrame, key: str, text: str, first: str, last: str) -> DataFrame:
    """The first and the last of the ``tokens`` of each key's text; a text without any has no row.

    No token gets a row of its own.  Where no key repeats, a text is searched from either end; else the rows of a
    key are told apart by their tokens' positions, for which texts are split.  Only a first or last part can be empty."""
    if df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        run = lambda c: F.regexp_extract(c, TOKEN, 0)
        t = df.select(key, run(F.col(text)).alias("_f"), F.reverse(run(F.reverse(F.col(text)))).alias("_l"))
        return t.filter("_f <> ''").select(key, F.lower("_f").alias(first), F.lower("_l").alias(last))
    t = df.select(key, F.split(F.col(text), TOKEN_SPLIT).alias("_p"))
    t = t.select(key, "_p", F.expr("if(_p[0] = '', 1, 0)").alias("_i"), F.expr("size(_p) - if(_p[size(_p) - 1] = '', 2, 1)").alias("_j")).filter("_p is not null and _i <= _j")
    t = t.select(key, "_i", "_j", F.lower(F.expr("_p[_i]")).alias("_f"), F.lower(F.expr("_p[_j]")).alias("_l"))
    return t.groupBy(key).agg(F.min_by("_f", "_i").alias(first), F.max_by("_l", "_j").alias(last))


def anagram_key(c) -> F.Column:
    return F.array_join(F.array_sort(F.split(c, "")), "")


def group_anagrams(words: DataFrame, word: str = "word") -> DataFrame:
    """Each distinct word with its anagram key and the size of its group
    (long form: a group is never collected into one value)."""
    w = words.select(word).distinct().withColumn("anagram_key", anagram_key(F.col(word)))
    sizes = w.groupBy("anagram_key").agg(F.count(F.lit(1)).alias("group_size"))
    return w.join(sizes, "anagram_key")


def _deletion_keys(df: DataFrame, word: str, d: int) -> DataFrame:
    """(word, key): the word and every string obtained by deleting up to d chars."""
    cur = df.select(word, F.col(word).alias("key")).distinct()
    out = cur
    for _ in range(d):
        nxt = (cur.select(word, "key", F.explode(F.sequence(F.lit(1), F.greatest(F.length("key"), F.lit(1)))).alias("_i"))
                  .filter(F.length("key") > 0)
                  .select(word, F.concat(F.substring("key", 1, F.col("_i") - 1),
                                         F.expr("substring(key, _i + 1)")).alias("key")).distinct())
        out = out.unionByName(nxt).distinct()
        cur = nxt
    return out


def _one_edit_keys(df: DataFrame, word: str) -> DataFrame:
    """(word, key, pos): the word itself (pos -1) and each single deletion
    tagged with the deleted position."""
    dels = (df.select(word, F.explode(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1)))).alias("pos"))
              .filter(F.length(word) > 0)
              .select(word, F.concat(F.substring(word, 1, F.col("pos") - 1),
                                     F.expr(f"substring(`{word}`, pos + 1)")).alias("key"), "pos"))
    return df.select(word, F.col(word).alias("key"), F.lit(-1).alias("pos")).unionByName(dels)


def fuzzy_join(left: DataFrame, right: DataFrame | None, max_dist: int = 1, word: str = "word") -> DataFrame:
    """Pairs within Levenshtein distance ``max_dist``.

    Distance 1 is keyed so that every candidate is a true match:
    substitutions share (deletion, position); an insertion pairs the
    shorter word itself with a deletion of the longer one.  A key group
    then only holds words that are pairwise at distance exactly 1, so the
    work is proportional to the output.  Larger distances use deletion
    neighbourhoods (exact, with candidates verified by
    ``levenshtein(a, b, d)``).  With ``right`` None it is a self-join
    returning pairs a < b.
    """
    l = left.select(F.col(word).alias("a")).distinct()
    r = (right if right is not None else left).select(F.col(word).alias("b")).distinct()
    if max_dist == 0:
        cand = l.join(r, l["a"] == r["b"])
    elif max_dist == 1:
        lk = _one_edit_keys(l, "a").withColumnRenamed("pos", "pa")
        rk = _one_edit_keys(r, "b").withColumnRenamed("pos", "pb")
        same = lk.filter(F.col("pa") >= 0).join(rk.filter(F.col("pb") >= 0), "key") \
            .filter(F.col("pa") == F.col("pb"))
        ins = lk.filter(F.col("pa") < 0).join(rk.filter(F.col("pb") >= 0), "key")
        dele = lk.filter(F.col("pa") >= 0).join(rk.filter(F.col("pb") < 0), "key")
        exact = l.join(r, l["a"] == r["b"])
        cand = (same.select("a", "b").unionByName(ins.select("a", "b")).unionByName(dele.select("a", "b"))
                    .unionByName(exact.select("a", "b")).distinct())
    else:
        lk = _deletion_keys(l, "a", max_dist)
        rk = _deletion_keys(r, "b", max_dist)
        cand = lk.join(rk, "key").select("a", "b").distinct()
    if right is None:
        cand = cand.filter(F.col("a") < F.col("b"))
    dist = F.levenshtein("a", "b", max_dist)
    return cand.withColumn("dist", dist).filter(F.col("dist") >= 0).withColumn("dist", F.col("dist").cast("int"))


def _ways(size: int, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Segments with the words found in them -> the ways through each: (_i, _o) if a way that enters ``_i`` characters
    behind the segment's start can leave it ``_o`` behind its end (0 at the end of the text).

    ``_found`` holds place * (longest + 1) + length of each word, in order; a place's bit i says that entry i reaches it."""
    def run(batches):
        for batch in batches:
            out = []
            for text, n, s, found in zip(*(batch.column(c).to_pylist() for c in ("_id", "_n", "_b", "_found"))):
                length = min(size, n - s * size)
                reach = [0] * (length + longest)
                for i in range(min(longest, length + 1) if s else 1):
                    reach[i] = 1 << i
                for f in found:
                    k, l = divmod(f, longest + 1)
                    if reach[k]:
                        reach[k + l] |= reach[k]
                for o in range(1 if (s + 1) * size >= n else longest):
                    entries = reach[length + o]
                    while entries:
                        i = entries & -entries
                        out.append((text, n, s, i.bit_length() - 1, o))
                        entries ^= i
            columns = zip(*out) if out else ((),) * 5
            kinds = (pa.int64(), *[pa.int32()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["_id", "_n", "_b", "_i", "_o"])
    return run


def segmentable(texts: DataFrame, words: DataFrame, text: str = "text", word: str = "word") -> DataFrame:
    """Whether each distinct text can be cut completely into dictionary words (the empty text can; a null one has null).

    Texts are cut into segments of ``SEGMENT`` characters (the longest word's, if that is more), the words that
    start in a segment are found by a join, and a segment becomes a relation: entered so many characters behind its start, it
    can be left so many behind its end.  Relations of neighbours are joined pair by pair, in rounds as many
    as the logarithm of the segments; a text can be cut if its own takes 0 to 0.  A segment's words are at most its
    characters times the lengths words have, and a relation the square of the longest word's length.
    """
    d, _ = checked_broadcast(words.select(F.col(word).alias("_w")).distinct().filter(F.length("_w") > 0))
    lengths = sorted(r[0] for r in d.select(F.length("_w")).distinct().collect())  # at most the longest word's length of them
    t = staged(texts.select(F.col(text).alias("_t")).distinct().withColumn("_id", F.monotonically_increasing_id()))
    whole = t.select(F.col("_t").alias(text), "_id")
    if not lengths:
        return whole.select(text, (F.length(text) == 0).alias("segmentable"))
    longest = lengths[-1]
    size = max(SEGMENT, longest)
    seg = t.filter(F.length("_t") > 0).select("_id", "_t", F.length("_t").alias("_n"), F.explode(F.expr(f"sequence(0, cast((length(_t) - 1) div {size} as int))")).alias("_b"))
    seg = seg.select("_id", "_n", "_b", F.expr(f"substring(_t, _b * {size} + 1, {size + longest - 1})").alias("_c"))
    at = seg.withColumn("_k", F.explode(F.expr(f"sequence(0, least({size}, _n - _b * {size}) - 1)")))
    subs = at.withColumn("_l", F.explode(F.lit(lengths))).filter("_k + _l <= length(_c)")
    hits = subs.withColumn("_w", F.expr("substring(_c, _k + 1, _l)")).join(d, "_w", "left_semi") \
        .select("_id", "_n", "_b", F.expr(f"_k * {longest + 1} + _l").alias("_f"))
    # a segment without a word can still hold the end of one
    every = hits.unionByName(seg.select("_id", "_n", "_b", F.lit(None).cast("int").alias("_f")))
    per = every.groupBy("_id", "_n", "_b").agg(F.array_sort(F.collect_list("_f")).alias("_found"))
    rel = staged(per.mapInArrow(_ways(size, longest), "_id bigint, _n int, _b int, _i int, _o int"))
    most, width = rel.agg(F.max("_n")).first()[0] or 0, size
    while width < most:
        pair = F.expr("_b div 2").cast("int").alias("_b")
        left, right = rel.filter("_b % 2 = 0"), rel.filter("_b % 2 = 1").select("_id", pair, F.col("_i").alias("_m"), "_o")
        both = left.select("_id", "_n", pair, "_i", F.col("_o").alias("_m")).join(right, ["_id", "_b", "_m"]).select("_id", "_n", "_b", "_i", "_o").distinct()
        alone = left.filter(f"_b = (_n - 1) div {width}").select("_id", "_n", pair, "_i", "_o")
        joined = staged(both.unionByName(alone))
        drop_staged(rel)
        rel, width = joined, 2 * width
    cut = rel.select("_id", F.lit(True).alias("_cut"))  # what is left goes from 0 to 0
    return whole.join(cut, "_id", "left").select(text, F.when(F.col(text).isNotNull(), F.coalesce("_cut", F.length(text) == 0)).alias("segmentable"))


def _patterns(df: DataFrame, word: str, *keep: str) -> DataFrame:
    """(word, pattern) with one position replaced by '*' (h*t, *it, hi*)."""
    return df.select(word, *keep, F.explode(F.sequence(F.lit(1), F.length(word))).alias("_i")).select(
        word, *keep, F.concat(F.substring(word, 1, F.col("_i") - 1), F.lit("*"), F.expr(f"substring(`{word}`, _i + 1)"))
        .alias("pattern"))


def word_ladder(words: DataFrame, pairs: DataFrame, word: str = "word", max_rounds: int = 10_000) -> DataFrame:
    """Number of words in the shortest one-letter-change chain begin -> end
    for each (pair_id, begin, end); 0 when end is not in the list or
    unreachable; 1 when begin = end.

    BFS over the bipartite word <-> wildcard-pattern graph of the list, so a
    crowded pattern is expanded once per search as all its word pairs never are.
    A begin word outside the list is no node that others may step through: its
    pair starts at the list words one letter away, with one step taken.
    Words and pairs are read once; from then on words are numbers.
    """
    vocab = staged(words.select(F.col(word).alias("w")).distinct().filter(F.length("w") > 0).withColumn("id", F.monotonically_increasing_id()))
    pairs = staged(pairs.select("pair_id", "begin", "end"))
    side = lambda c: vocab.select(F.col("w").alias(c), F.col("id").alias(f"_{c}"))
    known = pairs.filter((F.length("begin") == F.length("end")) & (F.col("begin") != F.col("end")))
    known = staged(known.join(side("end"), "end").join(side("begin"), "begin", "left"))
    ask = known.filter("_begin is not null").select("pair_id", F.col("_begin").alias("start"), F.col("_end").alias("end"), F.lit(0).alias("_taken"))
    outside = known.filter("_begin is null").select("pair_id", "begin", "_end")
    if not outside.isEmpty():
        starts = _patterns(outside.select("begin").distinct(), "begin").join(_patterns(vocab, "w", "id"), "pattern").select("begin", F.col("id").alias("start")).distinct()
        ask = ask.unionByName(outside.join(starts, "begin").select("pair_id", "start", F.col("_end").alias("end"), F.lit(1).alias("_taken")))
    ask = staged(ask.withColumn("_ask", F.monotonically_increasing_id()))
    # a pattern of one word leads nowhere: most patterns go before any search.  Those of a pattern differ in one letter,
    # so it has no more words than the alphabet letters; it takes the number of one of its rows
    of = Window.partitionBy("pattern")
    every = _patterns(vocab, "w", "id").select("pattern", F.col("id").alias("node"), F.monotonically_increasing_id().alias("_m"))
    every = every.select("node", F.min("_m").over(of).alias("hub"), F.min("node").over(of).alias("_low"), F.count(F.lit(1)).over(of).alias("_n"))
    links = staged(every.filter("_n > 1").drop("_n"))
    # Pairs whose ends lie in different components of the word graph are
    # unreachable: settle them with one connected-components job (O(log n)
    # rounds) instead of letting the searches exhaust their components.
    comp = connected_components(links, src="node", dst="_low")
    ends = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"_c{c}"))
    open_ = staged(ask.join(ends("start"), "start").join(ends("end"), "end").filter("_cstart = _cend and start <> end")
                   .select(F.col("_ask").alias("pair_id"), "start", "end", F.col("_cstart").alias("component")))
    asked = comp.join(open_.select("component").distinct(), "component", "left_semi").select("node")
    dist = pair_distance(None, open_, hubs=links.select("node", "hub").join(asked, "node", "left_semi"), max_rounds=max_rounds, near="component")
    here = ask.filter(F.col("start") == F.col("end")).select("_ask", F.lit(0).cast("bigint").alias("dist"))
    best = ask.join(dist.select(F.col("pair_id").alias("_ask"), "dist").unionByName(here), "_ask").groupBy("pair_id").agg(F.min(F.col("dist") + F.col("_taken")).alias("dist"))
    n = F.when(F.col("begin") == F.col("end"), F.lit(1)).otherwise(F.coalesce(F.col("dist") + 1, F.lit(0)))
    return pairs.join(best, "pair_id", "left").select("pair_id", "begin", "end", n.cast("int").alias("ladder_len"))


def html_tags(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, tag, is_close) for the open/close tags of each page.

    Comments, doctype and the contents of raw-text elements are removed
    first; void elements and self-closing tags carry no nesting and are dropped.
    """
    clean = F.regexp_replace(F.col(html), "(?s)<!--.*?-->", "")
    for tag in RAW_TEXT:
        clean = F.regexp_replace(clean, f"(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>", "")
    t = df.select(key, F.posexplode(F.regexp_extract_all(clean, F.lit("</?[A-Za-z][A-Za-z0-9]*[^>]*>"), 0))
                  .alias("pos", "_t"))
    t = t.select(key, F.col("pos").cast("bigint").alias("pos"),
                 F.lower(F.regexp_extract("_t", "^</?([A-Za-z][A-Za-z0-9]*)", 1)).alias("tag"),
                 F.col("_t").startswith("</").alias("is_close"),
                 F.col("_t").endswith("/>").alias("_self"))
    return t.filter(~F.col("tag").isin(list(VOID_TAGS)) & ~F.col("_self")).drop("_self")


def nesting_valid(tokens_df: DataFrame, keys, order: str, token: str, closes: str = "is_close",
                  pairs: Mapping[str, str] | None = None) -> DataFrame:
    """Whether open/close tokens balance and match, per key.

    Running depth; an opener's level is the depth after it, a closer's the
    depth before it; within a level the token just before a closer must be
    its opener.  ``pairs`` maps closer -> opener tokens when they differ
    (for tags the names are equal).
    """
    k = cols(keys)
    t = tokens_df.withColumn("_d", F.when(F.col(closes), -1).otherwise(1))
    r = running(t, k, [order], {"_depth": ("sum", "_d")})
    r = r.withColumn("_level", F.when(F.col(closes), F.col("_depth") + 1).otherwise(F.col("_depth")))
    m = running(r, k, [order], {"_prev_tok": ("last", token), "_prev_close": ("last", closes)},
                by="_level", exclusive=True)
    want = F.col(token)
    if pairs:
        want = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), F.col(token)),
                          F.col(token))
    bad_close = F.col(closes) & (F.col("_prev_tok").isNull() | F.col("_prev_close")
                                 | (F.col("_prev_tok") != want))
    agg = m.groupBy(*k).agg(F.min("_depth").alias("_mind"), F.max_by("_depth", order).alias("_end"),
                            F.max(bad_close.cast("int")).alias("_bad"), F.count(F.lit(1)).alias("n_tokens"))
    return agg.select(*k, ((F.col("_mind") >= 0) & (F.col("_end") == 0) & (F.col("_bad") == 0)).alias("valid"),
                      "n_tokens")
