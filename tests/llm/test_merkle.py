import hashlib
import zlib

import numpy as np
import pytest

from eventide.llm import merkle as M

from .helpers import none, odd, odd_rows, prose


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(level):
    """Root of a list of digests, and per leaf its (left, right) sibling texts from the bottom up."""
    ways, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for w, i in zip(ways, at):
            lo = i // 8 * 8
            w.append(("".join(level[lo:i]), "".join(level[i + 1:lo + 8])))
        level = [sha("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
        at = [i // 8 for i in at]
    return level[0], ways


def lowered(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def expected(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = climb([x[2] for x in groups[g]])
    root, over = climb([trees[g][0] for g in langs])
    out = []
    for g, top in zip(langs, over):
        for (_, _, leaf, r), way in zip(groups[g], trees[g][1]):
            way = way + top
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h = leaf_of([*r[:4], lowered(r[4])]) if changed else leaf
            for a, b in way:
                h = sha(a + h + b)
            out.append((r[0], leaf, trees[g][0], root, sha("".join(a + b for a, b in way)), h, h == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout(levels):
    at = M.addresses(levels)
    assert sorted(np.concatenate(at).tolist()) == list(range(M.nodes(levels)))
    # a subtree below the upper half is stored together
    top = levels // 2
    size = M.nodes(levels - top)
    for i in range(8 ** top if levels > 1 else 0):
        own = np.concatenate([a[i * 8 ** d:(i + 1) * 8 ** d] for d, a in enumerate(at[top:])])
        assert own.max() - own.min() == size - 1


@pytest.mark.parametrize("leaves", [1, 2, 8, 9, 64, 65, 500, 512])
def test_block(leaves):
    digests = [hashlib.sha256(bytes([i % 256, i // 256])).hexdigest() for i in range(leaves)]
    b = M.Block.build(np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(-1, 32), M.depth(leaves))
    root, ways = climb(digests)
    assert b.root.hex() == root
    got = list(b.paths())
    assert [[(x.decode(), y.decode()) for x, y in p] for p in got] == ways
    assert all(M.unpack(M.pack(p)) == p and M.fold(d.encode(), p).decode() == root for d, p in zip(digests, got))


def test_manifest_against_plain_trees(spark):
    texts = prose(5, 1400, most=8)
    rows = [(i * 7 % 1400, f"s{i % 3}", ("en", "fr", None)[0 if i % 10 else i % 3], len(t), t.title()) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    got = rows_of(M.report(df))
    assert got == expected(rows)
    assert len({r[6] for r in got}) == 2


def test_many_groups_and_several_tiers(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 2)
    monkeypatch.setattr(M, "BLOCK", 8)
    rows = [(i, "s", "hot" if i % 2 else f"l{i % 301}", 1, "Ab") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    leaves = df.select("doc_id", "lang", M.leaf(*[df[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("d"))
    m = M.manifest(leaves, "lang", "doc_id")
    got = {r.c0: (r.leaf, r.subroot, r.root, tuple(r.proof), r.verified) for r in M.proofs(m).collect()}
    want = {r[0]: r for r in expected(rows)}
    assert set(got) == set(want)
    for i, (leaf, sub, root, proof, ok) in got.items():
        assert ok and (leaf, sub, root) == want[i][1:4] and sha("".join(proof)) == want[i][4]


def test_odd_rows(spark):
    # (doc_id, text, lang, source, n_chars)
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows()]
    assert rows_of(M.report(odd(spark))) == expected(rows)


def test_one_row_and_empty_table(spark):
    one = odd(spark).filter("doc_id = 6").limit(1)
    r = M.report(one).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == sha("")
    assert M.report(none(spark)).count() == 0
