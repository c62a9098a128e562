import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventide.llm import bpe

from .helpers import none, odd, odd_rows, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def enc():
    return bpe.Encoder(bpe.vocabulary(PATH))


def library(t):
    ids = LIB.encode(t or "", add_special_tokens=False).ids
    return ids, LIB.decode(ids, skip_special_tokens=False)


def fuzz(n=1500):
    r = random.Random(4)
    bits = ["a", " ", "\n", "'s", "é", "1", "½", "日", "\t", ",", "the ", " of", "\x1d", " ", "\xa0", "😀", "_", "'", "ll", "ǅ", "ª", "×", "٣", "Ⅻ"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 50))) for _ in range(n)]


def test_encoder_is_the_library(enc):
    for t in fuzz() + [t or "" for _, t, *_ in odd_rows()]:
        ids, text = library(t)
        assert enc.ids(enc.part(t)).tolist() == ids, repr(t)
        assert enc.decode(ids).decode() == text


@pytest.mark.parametrize("recurs", [True, False])
def test_joins_are_repaired_exactly(enc, recurs):
    r = random.Random(5)
    long = ["".join(r.choice(fuzz(200)) for _ in range(300)), "日本語" * 9000, "x" * 40000, "ab " * 30000, " ".join(prose(1, 200))]
    for t in long:
        raw = np.frombuffer(t.encode(), np.uint8)
        known = {h: enc.part(c[a:b]) for c, a, b, h in bpe.chunks(raw) if h}
        pieces = bpe.outline(enc, raw, lambda h: recurs)
        assert len(pieces) > 1 or not recurs or " " not in t
        got = b"".join(known[p] if isinstance(p, bytes) else enc.part(p) for p in pieces)
        assert enc.ids(got).tolist() == library(t)[0]


def test_chunks_of_shared_passages_are_equal():
    shared = " ".join(prose(9, 400))
    a, b = ("one " * 300 + shared), ("another start, " * 77 + shared)
    ca, cb = ({c[3] for c in bpe.chunks(np.frombuffer(t.encode(), np.uint8))} for t in (a, b))
    assert len(ca & cb) > len(ca) // 2


def test_decode_of_broken_utf8(enc):
    ids = [i for i in range(len(enc.token_bytes)) if enc.token_bytes[i] and enc.token_bytes[i][0] >= 0xC0][:50]
    assert enc.decode(ids).decode() == LIB.decode(ids, skip_special_tokens=False)


def corpus():
    passage = " ".join(prose(3, 60))
    texts = [f"{i} {passage} tail {i}" for i in range(20)] + prose(5, 40) + [passage] * 5
    return [(i, t) for i, t in enumerate(texts)] + [(i, t) for i, t, *_ in odd_rows()]


def test_query_is_the_library(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(df, PATH, digest=True).collect()], key=str)
    want = []
    for i, t in rows:
        ids, text = library(t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_ids_and_odd_tables(spark):
    got = sorted(((r.doc_id, r.ids) for r in bpe.encode(odd(spark), PATH).collect()), key=str)
    assert got == sorted(((i, library(t)[0]) for i, t, *_ in odd_rows()), key=str)
    assert bpe.encode(none(spark), PATH, digest=True).count() == 0
