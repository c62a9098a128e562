import zlib
from collections import Counter

import numpy as np
import pytest

from eventide.llm import hilbert as H

from .helpers import none, odd, odd_rows

DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_steps_of_one(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    at = H.curve_index(grid, bits)
    assert sorted(at) == list(range(len(grid)))
    path = grid[np.argsort(at)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, texts, shards=40):
    count = Counter(r.shard for r in rows)
    n = len(rows)
    assert set(count) <= set(range(shards)) and max(count.values()) - min([count.get(s, 0) for s in range(shards)]) <= 1
    for s in count:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))
    assert n == len(texts)
    got = sorted(((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in rows), key=str)
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "rows", None) for i, t in texts), key=str)
    assert got == want
    by = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve_index for r in by] == sorted(r.curve_index for r in rows)


def test_shards_of_documents(spark):
    d = spark.read.parquet(DOCS)
    rows = H.shard(d).collect()
    check(rows, [(r.doc_id, r.text) for r in d.collect()])


def test_shards_are_narrow_in_every_dimension(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    meta = {r.doc_id: (r.lang, r.source, len(r.text.encode())) for r in d.collect()}
    rows = H.shard(d).collect()

    def files_read(shard_of):
        """Shards that filters on one value of each dimension can't skip, by minima and maxima."""
        held = {}
        for i, m in meta.items():
            held.setdefault(shard_of(i), []).append(m)
        ranges = [[(min(c), max(c)) for c in zip(*v)] for v in held.values()]
        picks = list(meta.values())[::25]
        return sum(r[k][0] <= p[k] <= r[k][1] for p in picks for k in range(3) for r in ranges)

    of = {r.doc_id: r.shard for r in rows}
    assert files_read(of.get) < 0.7 * files_read(lambda i: i % 40)


def test_odd_rows_and_empty_tables(spark):
    check(H.shard(odd(spark), dims=("lang", "source", "size")).collect(), [(i, t) for i, t, *_ in odd_rows()])
    assert H.shard(none(spark)).count() == 0


def test_one_odd_string_leaves_the_cells_fine(spark):
    rows = [(i, "x", "en", f"https://site{i % 200:03}.example.org/page") for i in range(4000)] + [(4000, "x", "en", "wiki")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = H.shard(d, dims=("source",)).collect()
    at = {}
    for r in got:
        at.setdefault(rows[r.doc_id][3], set()).add(r.shard)
    assert len({r.curve_index for r in got}) > 50
    assert max(map(len, at.values())) <= 3
