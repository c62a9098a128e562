import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventide.llm import tokenfile as W

from .helpers import none, odd, odd_rows, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n,bits", [(0, 16), (1, 16), (65536, 3), (70001, 16), (140000, 17)])
def test_wavelet_matrix(n, bits):
    r = np.random.default_rng(n)
    a = (r.integers(0, 1 << bits, n) * r.random(n) ** 3).astype(np.int64)
    s = W.Shard(W.build(a, np.array([n]), bits))
    assert (s.tokens() == a).all() and s.lengths.tolist() == [n]
    for i in r.integers(0, n, 20).tolist() if n else []:
        t, k = int(a[i]), int((a[:i] == a[i]).sum())
        assert s[i] == t and s.count(t, 0, i) == k and s.find(t, k) == i
    for t in (0, 5, (1 << bits) - 1, 1 << bits):
        assert s.count(t) == (a == t).sum()
        assert s.find(t, s.count(t)) == -1


def expected(rows):
    lib, at, out = Tokenizer.from_file(PATH), 0, {}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        out[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("shard", [50, 1 << 20])
def test_round_trip(spark, shard):
    rows = list(enumerate(prose(2, 120)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in W.round_trip(df, PATH, shard_tokens=shard).collect()}
    assert got == expected(rows)


def test_odd_and_empty_tables(spark):
    got = W.round_trip(odd(spark), PATH).orderBy("start").collect()
    assert len(got) == len(odd_rows())
    assert [r.doc_id for r in got] == sorted([i for i, *_ in odd_rows()], key=lambda i: (i is not None, i))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert W.round_trip(none(spark), PATH).count() == 0
