"""Order-dependent folds per key.

``sorted_fold`` is the one place where rows are handed to Python: the
input is hash-partitioned by key, sorted inside each partition by
(key, order) and streamed through ``mapInPandas`` in Arrow batches.  Only
the current key's state is held, so memory is bounded by the state, not
by the size of a key's group; a key's rows are never collected.
Associative recurrences avoid Python entirely (``max_nonadjacent_sum``
composes max-plus 2x2 matrices with ``aggregate``).
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cols

Step = Callable[[object, dict], tuple[object, tuple]]

CELL_CONF = "eventide.increasing.cell"  # rows of a key in one range of places or values
CELL = 1 << 20


def _ddl_fields(fields: Sequence[tuple[str, str]]) -> list[T.StructField]:
    return [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields]


def sorted_fold(df: DataFrame, keys, order, step: Step, out: Sequence[tuple[str, str]],
                finish: Callable[[object], tuple] | None = None,
                per_key: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Stream each key's rows, in ``order``, through ``step(state, row)``.

    Row mode: ``step`` returns (state, outputs) and every row is returned
    with ``out`` columns appended.  Key mode (``finish`` and ``per_key``
    given): one row per key, keys + ``finish(final_state)``.
    """
    k, o = cols(keys), cols(order)
    key_mode = finish is not None
    if key_mode:
        schema = T.StructType([df.schema[c] for c in k] + _ddl_fields(per_key or ()))
    else:
        schema = T.StructType(list(df.schema.fields) + _ddl_fields(out))
    names = [f.name for f in schema.fields]

    def fn(batches):
        cur, st, started = None, None, False
        for pdf in batches:
            recs = pdf.to_dict("records")
            rows_out, key_rows = [], []
            for r in recs:
                kv = tuple(r[c] for c in k)
                if not started or kv != cur:
                    if key_mode and started:
                        key_rows.append(list(cur) + list(finish(st)))
                    cur, st, started = kv, None, True
                st, res = step(st, r)
                if not key_mode:
                    rows_out.append(list(res))
            if key_mode:
                if key_rows:
                    yield pd.DataFrame(key_rows, columns=names)
            else:
                extra = pd.DataFrame(rows_out, columns=[n for n, _ in out], index=pdf.index)
                yield pd.concat([pdf, extra], axis=1)
        if key_mode and started:
            yield pd.DataFrame([list(cur) + list(finish(st))], columns=names)

    return (df.repartition(*k).sortWithinPartitions(*k, *o)
              .mapInPandas(fn, schema))


def max_nonadjacent_sum(df: DataFrame, keys, order, v: str) -> DataFrame:
    """Best sum of values with no two adjacent rows (values may be negative: skip them).

    dp_i = max(dp_{i-1}, dp_{i-2} + v_i) is a max-plus linear map
    [dp_i, dp_{i-1}] = M_i (x) [dp_{i-1}, dp_{i-2}] with
    M_i = [[0, v_i], [0, -inf]].  Matrix products are associative, so each
    key is reduced in ordered chunks (``aggregate`` over a sorted chunk)
    and the chunk products are multiplied in order.
    """
    k, o = cols(keys), cols(order)
    NEG = -1e300
    FAN = 4096
    # chunk = position bucket of fixed size so one key never becomes one array
    from .scan import running
    pos = running(df.select(*k, *o, v), k, o, {"_c": ("count", "_c")})
    ident = "named_struct('a', 0D, 'b', CAST(-1e300 AS DOUBLE), 'c', CAST(-1e300 AS DOUBLE), 'd', 0D)"
    # product P = M_n ... M_1 ; new = M (x) acc:  [[0,v],[0,-inf]] (x) [[a,b],[c,d]]
    mul_step = ("(acc, m) -> named_struct("
                "'a', greatest(m.a + acc.a, m.b + acc.c), 'b', greatest(m.a + acc.b, m.b + acc.d), "
                "'c', greatest(m.c + acc.a, m.d + acc.c), 'd', greatest(m.c + acc.b, m.d + acc.d))")
    mats = pos.withColumn("_m", F.expr(f"named_struct('a', 0D, 'b', CAST({v} AS DOUBLE), 'c', 0D, "
                                       f"'d', CAST({NEG} AS DOUBLE))"))
    # level 0: products of ordered runs of <= FAN matrices; each further level
    # multiplies <= FAN consecutive products, so no array exceeds FAN entries
    cur = mats.select(*k, F.col("_c").alias("_i"), F.col("_m").alias("_p"))
    most = cur.agg(F.max("_i")).first()[0] or 0  # the longest key: one product per key must be left
    while most > 1:
        most = -(-most // FAN)
        cur = (cur.withColumn("_g", F.floor((F.col("_i") - 1) / F.lit(FAN)).cast("bigint") + 1)
                  .groupBy(*k, "_g")
                  .agg(F.sort_array(F.collect_list(F.struct("_i", "_p"))).alias("_ps"))
                  .select(*k, F.col("_g").alias("_i"),
                          F.expr(f"aggregate(transform(_ps, x -> x._p), {ident}, {mul_step})").alias("_p")))
    per_key = cur.groupBy(*k).agg(F.first("_p").alias("_P"))
    # initial vector [dp_0, dp_-1] = [0, 0]
    return per_key.select(*k, F.greatest(F.col("_P.a"), F.col("_P.b"), F.lit(0.0)).alias("max_nonadjacent_sum"))


def _insert_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run the sorted rows of whole cells, one cell after the other, through their tails (see ``longest_increasing``).

    A row with ``_pos`` -1 is a tail the cell starts with, one with ``_val`` -1 takes the smallest tail away,
    any other puts its value in.  Out come, per cell, a row (-1, -1) with the growth of its tails, the tails for
    the cell at later places and the removals for the cell of greater values.
    """
    tails, low, before, cell, held = [], 0, 0, None, None
    took: list[int] = []
    out: list[tuple[int, int, int, int]] = []

    def emit(at: int, *row: int) -> None:
        took.append(at)
        out.append(row)

    def close(at: int) -> None:
        p, i, j = cell
        emit(at, -1, -1, -1, len(tails) - low - before)
        if i + 1 < p:
            for v in tails[low:]:
                emit(at, i + 1, j, -1, v)

    def packed(rows: pa.Table) -> list[pa.RecordBatch]:
        keys = rows.take(pa.array(took, pa.int64()))
        for name, column in zip(("_i", "_j", "_pos", "_val"), zip(*out) if out else ((),) * 4):
            keys = keys.append_column(name, pa.array(column, pa.int64()))
        took.clear()
        out.clear()
        return keys.combine_chunks().to_batches()

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        p, i, j, pos, val, first = (rows[c].to_pylist() for c in ("_p", "_i", "_j", "_pos", "_val", "_first"))
        keys = rows.drop_columns(["_i", "_j", "_pos", "_val", "_first"])
        shift = 0 if held is None else 1  # the row before this batch, whose cell may end here
        if held is not None:
            keys = pa.concat_tables([held, keys])
        for r in range(len(pos)):
            if first[r]:
                if cell is not None:
                    close(r + shift - 1)
                tails, low, before, cell = [], 0, 0, (p[r], i[r], j[r])
            up = cell[2] + 1 < cell[0]
            if pos[r] < 0:
                tails.append(val[r])
                before += 1
            elif val[r] < 0:
                if low < len(tails):
                    low += 1
                elif up:
                    emit(r + shift, cell[1], cell[2] + 1, pos[r], -1)
            else:
                at = bisect_left(tails, val[r], low)
                if at < len(tails):
                    tails[at] = val[r]
                else:
                    tails.append(val[r])
                    if up:
                        emit(r + shift, cell[1], cell[2] + 1, pos[r], -1)
        if keys.num_rows:
            held = keys.slice(keys.num_rows - 1)
            yield from packed(keys)
    if cell is not None:
        close(0)
        yield from packed(held)


def longest_increasing(df: DataFrame, keys, order, v: str) -> DataFrame:
    """Length of the longest strictly increasing subsequence per key; null values take no part (a key without others: 0).

    A value put among the tails of the increasing chains replaces the smallest tail that is not below it, or
    is added; there are as many tails in the end as the longest chain has rows.  Places and values (as ranks, equal
    values in falling order of place) are cut into ranges of ``CELL_CONF`` rows, which makes cells.  A cell only
    needs the tails of its value range that earlier places left, and a sign for each value that found nothing
    to replace in a lower range: that takes the smallest tail here, or is passed on.  So all cells of a
    diagonal run at once, in different tasks, each bounded by its ranges; the rounds are twice the longest
    key's rows over the range, whatever the answer.
    """
    from ..session import drop_staged, scratch_path, staged
    from .scan import checked_broadcast, running, same

    k, o = cols(keys), cols(order)
    spark = df.sparkSession
    side = int(spark.conf.get(CELL_CONF, None) or CELL)
    has = df.filter(F.col(v).isNotNull()).select(*dict.fromkeys([*k, *o, v]))
    at = running(has, k, o, {"_pos": ("count", "_pos")}).select(*k, F.col(v).alias("_v"), "_pos", (-F.col("_pos")).alias("_back"))
    at = running(at, k, ["_v", "_back"], {"_val": ("count", "_val")})
    wide, _ = checked_broadcast(has.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(k)])
                                   .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > side))
    part = lambda c: F.expr(f"({c} - 1) div {side}")
    cells = at.join(wide, same(at, wide, [(c, f"_k{i}") for i, c in enumerate(k)]), "left").select(
        *k, F.coalesce(part("_n") + 1, F.lit(1)).alias("_p"), part("_pos").alias("_i"), part("_val").alias("_j"), "_pos", "_val")
    cells = staged(cells.withColumn("_d", F.col("_i") + F.col("_j")).sortWithinPartitions("_d"))
    schema = cells.drop("_d").schema
    grown = scratch_path(spark, "staged")
    w = Window.partitionBy(*k, "_i", "_j").orderBy("_pos", "_val")
    carry = None
    for d in range(2 * (cells.agg(F.max("_p")).first()[0] or 1) - 1):
        now = cells.filter(F.col("_d") == d).drop("_d")
        if carry is not None:
            now = now.unionByName(carry.filter("_i >= 0"))
        out = staged(now.withColumn("_first", F.row_number().over(w) == 1).mapInArrow(_insert_cells, schema))
        out.filter("_i < 0").select(*k, "_val").write.mode("append").parquet(grown)
        if carry is not None:
            drop_staged(carry)
        carry = out
    drop_staged(carry)
    drop_staged(cells)
    none = df.filter(F.col(v).isNull()).select(*k, F.lit(0).cast("bigint").alias("_val"))
    lengths = spark.read.schema(none.schema).parquet(grown)
    return lengths.unionByName(none).groupBy(*k).agg(F.sum("_val").alias("lis_length"))


def min_removals_fold(df: DataFrame, keys, start: str, end: str) -> DataFrame:
    """Greedy interval scheduling by earliest end, streamed per key."""
    def step(st, r):
        last, kept, n = st if st is not None else (None, 0, 0)
        if last is None or r[start] >= last:
            last, kept = r[end], kept + 1
        return (last, kept, n + 1), ()

    return sorted_fold(df.select(*cols(keys), start, end), keys, [end, start], step, (),
                       finish=lambda s: (s[2] - s[1],), per_key=[("min_removals", "bigint")])
