"""Keyed and global scans over ordered rows, without a task that holds a whole key.

``split`` range-partitions the rows by (keys, order): by the real values of
all order columns, so strings and ties of the leading column are cut like any
others.  Each range is a *piece*; the piece number is written with the rows,
once, so that every later use sees the same pieces.  There is no switch on
sizes: a small input just has few pieces.

``running`` scans each (key, piece) in a window of its own and adds the
aggregate of the key's earlier (or later) pieces.  Only keys that reach over a
piece's end need that; they are at most as many as there are pieces, found from
each piece's first and last key.

``global_rank`` and ``global_prefix_sum`` are the same with one key: a row's
place in its sorted piece plus one number per earlier piece.

Supported aggregates: sum, count, min, max and ``last`` (the previous
row's value, i.e. ``lag``; ``lead`` for suffix scans).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cols
from ..session import staged

PIECES_CONF = "eventide.scan.pieces"  # number of pieces; unset: Spark's number of shuffle partitions
BROADCAST_BYTES_CONF = "eventide.broadcast.maxBytes"
DEFAULT_BROADCAST_BYTES = 16 << 20
PIECE = "__eventide_piece"  # internal column; never a user column name
_PLACE = "__eventide_place"


def _conf_int(df: DataFrame, key: str, default: int | None) -> int | None:
    v = df.sparkSession.conf.get(key, None)
    return int(v) if v else default


def checked_broadcast(small: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Broadcast ``small`` (staged once) only if its measured size is within the limit.

    The size is that of all rows as text, an upper bound of order; beyond the
    limit the frame is returned without a hint and joins by shuffle.
    """
    limit = max_bytes or _conf_int(small, BROADCAST_BYTES_CONF, DEFAULT_BROADCAST_BYTES)
    kept = staged(small)
    size = kept.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] if kept.columns else 0
    return (F.broadcast(kept), True) if (size or 0) <= limit else (kept, False)


@dataclass
class Split:
    """Rows with their piece number, and the keys (at most one per piece) that reach over a piece's end."""

    df: DataFrame
    keys: list[str]
    wide: DataFrame | None


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    n = _conf_int(df, PIECES_CONF, None)
    return df.repartitionByRange(*([n] if n else []), *order)


def split(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> Split:
    """Cut the rows into pieces by the ranges of (keys, order)."""
    k, o = cols(keys), cols(order)
    rows = staged(_ranged(df, [*k, *o]).withColumn(PIECE, F.spark_partition_id()))
    if not k:
        return Split(rows, k, None)
    key = F.struct(*k)
    ends = rows.groupBy(PIECE).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))  # a row per piece
    w = Window.orderBy(PIECE)
    wide = [r["hi"] for r in ends.withColumn("next", F.lead("lo").over(w)).filter("hi <=> next").select("hi").distinct().collect()]
    schema = rows.select(*k).schema
    return Split(rows, k, df.sparkSession.createDataFrame([tuple(r) for r in wide], schema) if wide else None)


def _window_expr(how: str, c: str, w: Window, reverse: bool, exclusive: bool) -> Column:
    if how == "last":
        # wrapped so a null value is told apart from "no neighbour"
        sc = F.struct(F.col(c).alias("v"))
        return (F.lead(sc, 1) if reverse else F.lag(sc, 1)).over(w)
    lo, hi = ((1 if exclusive else 0), Window.unboundedFollowing) if reverse else \
        (Window.unboundedPreceding, (-1 if exclusive else 0))
    fw = w.rowsBetween(lo, hi)
    if how == "count":
        return F.count(F.lit(1)).over(fw)
    return getattr(F, how)(c).over(fw)


def same(left: DataFrame, right: DataFrame, names: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality: a null key is a group of its own, as in a window."""
    cond = F.lit(True)
    for a, b in names:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def in_wide(s: Split, df: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key reaches over a piece's end (at most one key per piece is broadcast)."""
    wide = s.wide.toDF(*[f"__w{i}" for i in range(len(s.keys))])
    return df.join(F.broadcast(wide), same(df, wide, [(c, f"__w{i}") for i, c in enumerate(s.keys)]), "left_semi")


def running(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
            specs: Mapping[str, tuple[str, str]], *, by: str | Sequence[str] = (),
            exclusive: bool = False, reverse: bool = False, pieces: Split | None = None) -> DataFrame:
    """Add prefix (or suffix when ``reverse``) aggregates per key.

    ``specs`` maps output column -> (how, input column).  ``order`` must be
    a total order within (keys, by), or rows that tie must be alike.  An
    operator that scans the same keys and order several times passes the
    ``pieces`` it got from ``split`` with rows derived from theirs.
    """
    k, o, b = cols(keys), cols(order), cols(by)
    own = pieces is None
    if own:
        pieces = split(df, k, o)
        df = pieces.df
    part = [*k, *b]
    w = Window.partitionBy(*part, PIECE).orderBy(*o)
    if pieces.wide is None:
        out = df
        for name, (how, c) in specs.items():
            e = _window_expr(how, c, w, reverse, exclusive)
            out = out.withColumn(name, e.getField("v") if how == "last" else e)
        return out.drop(PIECE) if own else out

    local = df
    for name, (how, c) in specs.items():
        local = local.withColumn(f"_l_{name}", _window_expr(how, c, w, reverse, exclusive))

    # totals per piece of the wide keys, then an exclusive scan over pieces
    ordstruct = F.struct(*[F.col(c) for c in o])
    aggs = []
    for name, (how, c) in specs.items():
        if how == "count":
            aggs.append(F.count(F.lit(1)).alias(f"_p_{name}"))
        elif how == "last":
            pick = F.min_by if reverse else F.max_by
            aggs.append(pick(F.struct(F.col(c).alias("v")), ordstruct).alias(f"_p_{name}"))
        else:
            aggs.append(getattr(F, how)(c).alias(f"_p_{name}"))
    per = in_wide(pieces, df).groupBy(*part, PIECE).agg(*aggs)
    ws = Window.partitionBy(*part).orderBy(PIECE)
    ws = ws.rowsBetween(1, Window.unboundedFollowing) if reverse else \
        ws.rowsBetween(Window.unboundedPreceding, -1)
    carry = per
    for name, (how, _c) in specs.items():
        p = F.col(f"_p_{name}")
        if how == "last":
            e = (F.first(p, ignorenulls=True) if reverse else F.last(p, ignorenulls=True)).over(ws)
        elif how == "count":
            e = F.sum(p).over(ws)
        else:
            e = getattr(F, how)(p).over(ws)
        carry = carry.withColumn(f"_c_{name}", e)
    jk = [*part, PIECE]
    carry = carry.select(*[F.col(c).alias(f"_k_{i}") for i, c in enumerate(jk)], *[f"_c_{n}" for n in specs])
    if not b:  # at most two rows per piece and wide key: bounded by twice the number of pieces
        carry = F.broadcast(carry)
    out = local.join(carry, same(local, carry, [(c, f"_k_{i}") for i, c in enumerate(jk)]), "left") \
               .drop(*[f"_k_{i}" for i in range(len(jk))])
    for name, (how, _c) in specs.items():
        lc, cc = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if how == "sum":
            e = F.when(lc.isNull() & cc.isNull(), F.lit(None)).otherwise(
                F.coalesce(lc, F.lit(0)) + F.coalesce(cc, F.lit(0)))
        elif how == "count":
            e = lc + F.coalesce(cc, F.lit(0))
        elif how == "min":
            e = F.least(lc, cc)
        elif how == "max":
            e = F.greatest(lc, cc)
        else:  # last
            e = F.coalesce(lc, cc).getField("v")
        out = out.withColumn(name, e)
    keep = [c for c in df.columns if not (own and c == PIECE)]
    return out.select(*keep, *[n for n in specs if n not in df.columns])


def _offsets(per_piece: DataFrame, value: str) -> dict[int, object]:
    """Exclusive prefix sums over pieces (a number per piece reaches the driver)."""
    out, at = {}, 0
    for r in sorted(per_piece.collect(), key=lambda r: r[PIECE]):
        out[r[PIECE]] = at
        at = at + (r[value] or 0)
    return out


def _looked_up(table: Mapping[int, object], piece: Column, kind) -> Column:
    if not table:
        return F.lit(0).cast(kind)
    return F.element_at(F.create_map(*[x for p, v in table.items() for x in (F.lit(p), F.lit(v).cast(kind))]), piece)


def global_rank(df: DataFrame, order: str | Sequence[str], name: str = "rank") -> DataFrame:
    """0-based rank of every row in a global order, one shuffle: the row's place in its sorted piece
    plus the rows of the pieces before.  Rows that tie are spread by a last, arbitrary order column."""
    o = [F.col(c) for c in cols(order)]
    n = _conf_int(df, PIECES_CONF, None)
    tied = df.withColumn(_PLACE, F.monotonically_increasing_id())
    rows = tied.repartitionByRange(*([n] if n else []), *o, F.col(_PLACE)).sortWithinPartitions(*o, _PLACE) \
               .withColumn(_PLACE, F.monotonically_increasing_id()).withColumn(PIECE, F.spark_partition_id())
    rows = staged(rows)
    off = _offsets(rows.groupBy(PIECE).agg(F.count(F.lit(1)).alias("n")), "n")
    place = F.col(_PLACE).bitwiseAND((1 << 33) - 1)
    return rows.withColumn(name, (_looked_up(off, F.col(PIECE), "bigint") + place).cast("bigint")).drop(PIECE, _PLACE)


def global_prefix_sum(df: DataFrame, order: str | Sequence[str], value: str, name: str,
                      exclusive: bool = True) -> DataFrame:
    """Running sum of ``value`` in a global order: a window per piece plus the sums of the pieces before."""
    o = cols(order)
    rows = split(df, [], o).df
    kind = rows.agg(F.sum(value)).schema[0].dataType
    off = _offsets(rows.groupBy(PIECE).agg(F.sum(value).alias("s")), "s")
    w = Window.partitionBy(PIECE).orderBy(*o).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    return rows.withColumn(name, _looked_up(off, F.col(PIECE), kind) + F.coalesce(F.sum(value).over(w), F.lit(0))).drop(PIECE)
