"""URL filtering: fixed rules first, then association rules mined from labels.

``parsed`` takes a url's host (after the first "://" up to "/", "?", "#" or
the end, A-Z lowered) and path (then up to "?", "#" or the end).  A fixed rule
fits its host and all subdomains where the path starts with the rule's path;
the longest wins.

Other urls are judged by rules "these tokens together => block" mined from labelled urls.
A url's tokens are every suffix of its host,
every path segment (digits as #), the file suffix, every query key and whether
there is a fragment: none is left out.

Support is a number of blocked urls (``MIN_BLOCKED``), so the smallest rule is
the same at every size of the table.  A rule needs ``MIN_CONFIDENCE``, ``MIN_LIFT``
and ``MIN_EVIDENCE`` (how many nats likelier its labels are at its own rate than at the
overall rate), which keeps chance combinations out.

* Single tokens are counted directly, all of them.
* Combinations can only be made of tokens with enough blocked urls, and one with
  a token that is a rule by itself changes no verdict.  The others grow level by level, from all
  of a url's usable tokens, however many they are or how far apart, to itemsets of any size.
* An itemset with too few blocked urls for the evidence has no rule above it.  One that as many urls hold as
  hold a part of it (a host's suffixes, say), or that holds a part that is always blocked, is beaten by that part, and so
  is everything above it: neither is extended.  No itemset that could be a rule is lost by that.
* A rule is dropped if one with some of its tokens is as confident.

Counting and matching use an inverted index: an itemset is filed under its
rarest token, the different token sets of all urls (not the urls) are looked up by
their tokens, and an itemset matches if the set holds all of its tokens.  The most
confident rule gives the verdict.  Rules stay in tables; none passes the driver.

Defined cases: a url that is null or has no "://" has an empty host and path and
no tokens, so it is allowed; without labels, or if no rule survives, every
unruled url is allowed; repeated rows give repeated rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

MIN_BLOCKED, MIN_CONFIDENCE, MIN_LIFT, MIN_EVIDENCE = 5, 0.8, 1.5, 14.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # verdict, host, path


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest fixed rule that fits, or null."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1], r[2]))
    out = None
    for verdict, h, p in order:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The url's tokens in the url's order, without repeats."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.lit("host:"), F.array_join(F.slice(labels, n - k + 1, k), ".")))
    blank = lambda c: F.regexp_replace(c, "[0-9]+", "#")
    parts = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.concat(F.lit("path:"), blank(s)))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda q: F.regexp_extract(q, "^([^=]*)", 1)), lambda q: q != "")
    file = F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1)
    rest = F.array_compact(F.array(F.when(file != "", F.concat(F.lit("file:"), file)), F.when(F.instr(url, "#") > 0, F.lit("fragment"))))
    every = F.concat(suffixes, parts, F.transform(keys, lambda k: F.concat(F.lit("key:"), k)), rest)
    return F.when(host != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _good(rules: DataFrame, rate: float, min_blocked: int, min_confidence: float, min_lift: float, min_evidence: float) -> DataFrame:
    """Rows (n, blocked) that are rules, with their confidence."""
    c = F.col("confidence")
    evidence = F.col("blocked") * F.log(c / rate) + F.when(c < 1, (F.col("n") - F.col("blocked")) * F.log((1 - c) / (1 - rate))).otherwise(0.0)
    return rules.withColumn("confidence", F.col("blocked") / F.col("n")) \
        .filter((F.col("blocked") >= min_blocked) & (c >= min_confidence) & (c / rate >= min_lift)).filter(evidence >= min_evidence)


def _holding(sets: DataFrame, items: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``sets`` (with tokens) joined to each row of ``items`` (with rule, an array) all of whose tokens they
    hold; ``seen`` (token, n) tells which token of a rule is the rarest."""
    filed = items.withColumn("token", F.explode("rule")).join(seen.select("token", F.col("n").alias("seen_n")), "token") \
        .groupBy(*items.columns).agg(F.min_by("token", F.struct("seen_n", "token")).alias("token"))
    # two written sides, so that a frequent token's rows can be split
    return sets.withColumn("token", F.explode("tokens")).join(staged(filed), "token").filter(F.size(F.array_except("rule", "tokens")) == 0)


def _itemsets(sets: DataFrame, usable: DataFrame, least: int, max_items: int | None) -> DataFrame | None:
    """Itemsets (rule, n, blocked) of two and more of the ``usable`` tokens (token, n, blocked) that ``least`` blocked urls
    hold, without those that a part of them beats; ``sets`` has (tokens, n, blocked)."""
    rows = sets.withColumn("row", F.monotonically_increasing_id()).select("row", "n", "blocked", F.explode("tokens").alias("token"))
    held = staged(rows.join(usable.select("token"), "token").select("row", "n", "blocked", F.array("token").alias("rule")))
    level, found, size = usable.select(F.array("token").alias("rule"), "n", "blocked"), None, 1
    while max_items is None or size < max_items:
        size += 1
        one = held.select("row", "n", "blocked", F.slice("rule", 1, size - 2).alias("head"), F.element_at("rule", -1).alias("last"))
        two = held.select("row", F.slice("rule", 1, size - 2).alias("head"), F.element_at("rule", -1).alias("next"))
        longer = staged(one.join(two, ["row", "head"]).filter("last < next")
                        .select("row", "n", "blocked", F.concat("head", F.array("last", "next")).alias("rule")))
        counted = longer.groupBy("rule").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).filter(F.col("blocked") >= least)
        # every part with a token less must be on the level below, and held by more urls
        part = F.expr("transform(rule, x -> array_remove(rule, x))")
        parts = counted.withColumn("part", F.explode(part)).join(level.select(F.col("rule").alias("part"), F.col("n").alias("part_n")), "part")
        new = staged(parts.filter("part_n > n").groupBy("rule", "n", "blocked").agg(F.count(F.lit(1)).alias("parts"))
                     .filter(F.col("parts") == size).drop("parts"))
        if new.isEmpty():
            break
        found = new if found is None else found.unionByName(new)
        level = new.filter("n > blocked")
        held = staged(longer.join(level.select("rule"), "rule", "left_semi"))
    return found


def mined(labelled: DataFrame, min_blocked: int = MIN_BLOCKED, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT,
          min_evidence: float = MIN_EVIDENCE, max_items: int | None = None) -> DataFrame | None:
    """Rules (rule, n, blocked, confidence) for block, from rows (tokens, blocked); None without a blocked and an allowed row."""
    bad = F.col("blocked").cast("long")
    sets = staged(labelled.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.sum(bad).alias("blocked")))  # different token sets
    n, blocked = sets.agg(F.sum("n"), F.sum("blocked")).first()
    if not blocked or blocked == n:
        return None
    limits = (blocked / n, min_blocked, min_confidence, min_lift, min_evidence)
    seen = staged(sets.select(F.explode("tokens").alias("token"), "n", "blocked").groupBy("token")
                      .agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).filter(F.col("blocked") >= min_blocked))
    single = _good(seen.withColumn("rule", F.array("token")), *limits).select("rule", "n", "blocked", "confidence")
    single = staged(single)
    # at a given number of blocked urls the evidence is greatest if no others hold the itemset
    least = max(min_blocked, math.ceil(min_evidence / math.log(n / blocked) - 1e-9), 1)
    usable = seen.filter((F.col("blocked") >= least) & (F.col("n") < n)) \
        .join(single.select(F.col("rule")[0].alias("token")), "token", "left_anti")
    found = _itemsets(sets, staged(usable), least, max_items)
    if found is None:
        return single
    rules = staged(single.unionByName(_good(found, *limits).select(*single.columns)))
    # a part as confident as the rule: looked for among the rules that a token of the rule is filed under
    small = rules.select(F.col("rule").alias("part"), F.col("confidence").alias("by"), F.col("rule")[0].alias("token"))
    beaten = rules.filter(F.size("rule") > 1).withColumn("token", F.explode("rule")).join(small, "token") \
        .filter((F.size("part") < F.size("rule")) & (F.col("by") >= F.col("confidence")) & (F.size(F.array_except("part", "rule")) == 0))
    return staged(rules.join(beaten.select("rule").distinct(), "rule", "left_anti"))


def matched(sets: DataFrame, rules: DataFrame, seen: DataFrame) -> DataFrame:
    """(tokens, confidence): the token sets (distinct column tokens) that a rule matches, with the best confidence."""
    return _holding(sets, rules.select("rule", "confidence"), seen).groupBy("tokens").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule], page_col: str = "page_id", url_col: str = "url",
          **options) -> DataFrame:
    """Per page: its id, host, path, the fixed rule or null, verdict, and the mined rule's confidence or null.

    ``labels`` has (page id, blocked); pages without a label are not learned from.
    """
    url = F.col("url")
    host, path = parsed(url)
    p = pages.select(F.col(page_col).alias("id"), F.col(url_col).alias("url")) \
             .withColumn("host", host).withColumn("path", path) \
             .withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules)) \
             .withColumn("tokens", tokens(F.coalesce(url, F.lit("")), F.col("host"), F.col("path"))).drop("url")
    marked = labels.toDF("id", "blocked").groupBy("id").agg(F.max("blocked").alias("blocked"))
    p = staged(p)
    found = mined(p.select("id", "tokens").join(marked, "id").filter("blocked is not null"), **options)
    if found is not None:
        sets = staged(p.filter("fixed is null").select("tokens").distinct())
        seen = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        p = p.join(staged(matched(sets, found, seen)), "tokens", "left")
    else:
        p = p.withColumn("confidence", F.lit(None).cast("double"))
    own = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return p.select(F.col("id").alias(page_col), "host", "path", F.col("fixed.rule").alias("rule"),
                    F.coalesce(F.col("fixed.verdict"), own).alias("verdict"),
                    F.when(F.col("fixed").isNull(), F.col("confidence")).alias("confidence"))
