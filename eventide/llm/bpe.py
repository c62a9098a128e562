"""Byte-level BPE encoding with content-defined chunk reuse.

A text is cut into chunks where a rolling hash over its bytes says so, so equal
passages of different documents become equal chunks.  A chunk that occurs more
than once is encoded once, and its ids are joined back to every document that
holds it; a chunk that occurs once is encoded where it stands.

Cuts fall anywhere, also inside words.  A join is repaired by encoding anew
what lies around the cut.  The text before a space that is followed by a
character other than white space never shares a pre-token with what follows,
so encodings agree exactly from one such *safe* place to the next.  A chunk is
taken over only between its first and last safe place (its core); the window
around a cut begins at the last safe place before it and is widened chunk by
chunk until it ends at a safe place, where the re-encoded ids and the next
core agree.

To know which chunks recur, their 128-bit hashes alone are counted.  Recurring
ones are marked in a bit map of fixed size (``MAP_BITS``), which is broadcast.
Its false positives send a chunk that occurs once the way of the recurring
ones, which costs a little and changes nothing; so the size is bounded however
large the input is, and the result exact.

``Encoder`` encodes parts between safe places.  Texts of plain characters go
through ``pretokens``, block by block; the others are cut into units (what stands
between two safe places), whose ids are kept in a cache of bounded size, and new
ones go to the tokenizers library.

Defined cases: null is an empty text with no ids; a text that holds the
string of a special token is encoded whole by the library; equal rows give
equal results.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import blocks, utf8
from .bitmaps import bit_map, in_map
from .pretokens import Merges, Pretokens, classes
from .staging import staged

MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 512, 11, 16384
MAP_BITS = 1 << 25
CACHE = 100_000  # units of each of two generations

_GEAR = np.random.Generator(np.random.PCG64(4)).integers(0, 2**32, 256, dtype=np.uint32)
_REACH = 16  # bytes the rolling hash looks back on


def vocabulary(path: str) -> str:
    """The tokenizer's file as text: of fixed size, sent to the tasks with the code that uses it."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class Encoder:
    """Encodes and decodes texts exactly as the tokenizers library does."""

    def __init__(self, vocab: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(vocab)
        self.lib.no_truncation()
        self.lib.no_padding()
        conf = json.loads(vocab)
        self.special = [t["content"] for t in conf.get("added_tokens", [])]
        self._special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        pre = conf.get("pre_tokenizer") or {}
        self.fast = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                     and not conf.get("normalizer") and conf["model"].get("type") == "BPE"
                     and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in conf.get("added_tokens", [])))
        back = {c: bytes([b]) for b, c in enumerate(_byte_letters())}
        size = self.lib.get_vocab_size(with_added_tokens=True)
        self.wide = size > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.token_bytes = []
        for i in range(size):
            t = self.lib.id_to_token(i)
            self.token_bytes.append(b"" if t is None  # an id that no token has
                                    else t.encode() if t in self.special or any(c not in back for c in t)
                                    else b"".join([back[c] for c in t]))
        self._opens = np.array([t[:1] == b" " for t in self.token_bytes])
        self._known, self._old = {}, {}  # ids of " " + key
        self._pieces: dict[str, bytes] = {}  # ids of pre-tokens that are no word after a space
        self._tails: dict[str, bytes] = {}  # ids of what follows a word in a unit
        self._plain = self._pretokens(conf) if self.fast else None

    def _pretokens(self, conf: dict) -> Pretokens | None:
        model = conf["model"]
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        ids = model["vocab"]
        letters = _byte_letters()
        if any(model.get(k) for k in odd) or any(c not in ids for c in letters):
            return None
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        merges = Merges([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.array([ids[c] for c in letters]))
        return Pretokens(merges, self.by_library, self.dtype)

    def block(self, data: np.ndarray, off: np.ndarray) -> list[bytes]:
        """Ids of each row of a block of UTF-8 texts, as bytes of ``dtype``."""
        texts = lambda rows: [data[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace") for i in rows]
        n = len(off) - 1
        if self._plain is None:
            return self._by_units(texts(range(n)))
        c, odd = classes(data)
        slow = set(np.unique(np.searchsorted(off, odd, side="right") - 1).tolist())
        raw = data.tobytes() if self.special else b""
        for name in self.special:
            at = raw.find(name.encode())
            while at >= 0:
                slow.add(int(np.searchsorted(off, at, side="right")) - 1)
                at = raw.find(name.encode(), at + 1)
        if not slow:
            ids, cut = self._plain.encode(data, off, c)
            packed, cut = ids.tobytes(), (cut * self.dtype.itemsize).tolist()
            return [packed[a:b] for a, b in zip(cut, cut[1:])]
        rest = [i for i in range(n) if i not in slow]
        out: list[bytes] = [b""] * n
        for i, p in zip(sorted(slow), self._by_units(texts(sorted(slow)))):
            out[i] = p
        if rest:
            size = np.diff(off)[rest]
            sub = np.concatenate(([0], np.cumsum(size)))
            part = data[np.repeat(off[:-1][rest] - sub[:-1], size) + np.arange(sub[-1])]
            for i, p in zip(rest, self.block(part, sub)):
                out[i] = p
        return out

    def has_special(self, text: str) -> bool:
        return bool(self._special and self._special.search(text))

    def by_library(self, text: str) -> bytes:
        return np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words, each after a space: encoded in one text and cut where a token begins with a space."""
        # the fast call leaves out offsets, which nobody asks for
        ids = np.array(self.lib.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids, self.dtype)
        at = (np.flatnonzero(self._opens[ids]) * self.dtype.itemsize).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(at, at[1:] + [len(raw)])]

    def _piece(self, piece: str) -> bytes:
        got = self._pieces.get(piece)
        if got is None:
            got = self.by_library(piece)
            if len(piece) <= 64:
                if len(self._pieces) >= CACHE // 4:
                    self._pieces.clear()
                self._pieces[piece] = got
        return got

    def _head(self, text: str) -> bytes:
        """Ids of a unit that no space precedes."""
        if len(text) <= 64 and _PLAIN.fullmatch(text):
            return b"".join([self._piece(p) for p in _PATTERN.findall(text)])
        return self.by_library(text) if text else b""

    def _new(self, units: list[str]) -> dict[str, bytes]:
        """Ids of units, each after a space."""
        out, words, tails = {}, [], []
        known, old = self._known, self._old
        for u in units:
            m = _WORD_TAIL.fullmatch(u) if len(u) <= 64 else None
            if m is None:
                if len(u) <= 64 and _PLAIN.fullmatch(u):
                    out[u] = b"".join([self._piece(p) for p in _PATTERN.findall(" " + u)])
                else:
                    out[u] = self.by_library(" " + u)
            elif not m[2]:
                words.append(u)
            else:
                tails.append((u, m[1], m[2]))
        have = set(words)
        for _, w, _ in tails:
            if w not in have and w not in known and w not in old:
                have.add(w)
                words.append(w)
        if words:
            out.update(zip(words, self._words(words)))
        for u, w, tail in tails:
            ids = out.get(w) or known.get(w) or old[w]
            rest = self._tails.get(tail)
            if rest is None:
                rest = b"".join([self._piece(p) for p in _PATTERN.findall(tail)])
                if len(self._tails) < CACHE // 4:
                    self._tails[tail] = rest
            out[u] = ids + rest
        return out

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of ``dtype``."""
        raw = [t.encode() for t in texts]
        return self.block(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))

    def _by_units(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the texts' new units are encoded together."""
        if not self.fast:
            return [self.by_library(t) for t in texts]
        cut: list[tuple[str, list[str]] | None] = []
        for t in texts:
            if self._special and self._special.search(t):
                cut.append(None)
            elif _ODD_SPACE.search(t):
                cut.append(odd_units(t))
            else:
                units = t.split(" ")
                cut.append((units.pop(0), units))
        if len(self._known) > CACHE:
            self._old, self._known = self._known, {}
        known, old = self._known, self._old
        new = []
        for u in set().union(*[c[1] for c in cut if c]).difference(known):
            if u in old:
                known[u] = old[u]
            else:
                new.append(u)
        if new:
            known.update(self._new(new))
        get = known.__getitem__
        out = [self.by_library(t) if c is None else self._head(c[0]) + b"".join(map(get, c[1])) for t, c in zip(texts, cut)]
        for u in new:
            if len(u) > 64:  # long ones would fill the cache
                del known[u]
        return out

    def part(self, text: str) -> bytes:
        return self.many([text])[0]

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.dtype)

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text; bytes that are none become U+FFFD, as in the library."""
        table = self.token_bytes
        raw = b"".join([table[i] for i in ids])
        return raw.decode("utf-8", "replace").encode()


# For these characters, which fill most texts here, the pre-tokenizer's classes are plain to write
# down; what holds any other goes to the library itself.
_L = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
# a word after a space is one pre-token, and what follows it is cut as if it stood alone
_WORD_TAIL = re.compile(f"([{_L}]+)((?:[\\n\\t\\x21-\\x40\\x5b-\\x60\\x7b-\\x7e][{_L}\\n\\t\\x20-\\x7e]*)?)")
_PLAIN = re.compile(f"[{_L}\\n\\t\\x20-\\x7e]*")
_PATTERN = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[0-9]+| ?[^\s0-9{_L}]+|\s+(?!\S)|\s+")
_ODD_SPACE = re.compile(r" (?:\s|$)")


def odd_units(text: str) -> tuple[str, list[str]]:
    """The text cut before each space that a character other than white space follows: what stands
    before the first, and what follows each of them."""
    head, units = "", []
    for i, p in enumerate(text.split(" ")):
        if not i:
            head = p
        elif p and not p[0].isspace():
            units.append(p)
        elif units:
            units[-1] += " " + p
        else:
            head += " " + p
    return head, units


# ---- chunks ----

def cuts(raw: np.ndarray) -> list[int]:
    """Ends of the chunks of a text: places where the rolling hash's low bits are zero, at
    character boundaries, at least MIN_CHUNK and at most MAX_CHUNK bytes apart (where a
    character boundary allows it).  The hash of a place sees the _REACH bytes before it alone."""
    n = len(raw)
    if n <= MIN_CHUNK:
        return [n] if n else []
    g = _GEAR[raw]
    h = g.copy()
    reach = 1
    while reach < _REACH:  # h[i] = sum of g[i - j] << j, j < reach
        h[reach:] += h[:-reach] << np.uint32(reach)
        reach *= 2
    h ^= h >> np.uint32(15)
    ok = np.flatnonzero((h & np.uint32((1 << MEAN_BITS) - 1)) == 0) + 1
    ok = ok[ok < n]
    ok = ok[(raw[ok] & 0xC0) != 0x80].tolist()
    out, last, i = [], 0, 0
    while n - last > MIN_CHUNK:
        while i < len(ok) and ok[i] < last + MIN_CHUNK:
            i += 1
        at = ok[i] if i < len(ok) else n
        if at - last > MAX_CHUNK:
            at = last + MAX_CHUNK
            while at < n and (raw[at] & 0xC0) == 0x80:
                at += 1
        out.append(at)
        last = at
    if not out or out[-1] < n:
        out.append(n)
    return out


def core(text: str) -> tuple[int, int]:
    """First and last safe place of a chunk; equal if there is nothing between."""
    first = text.find(" ")
    while 0 <= first and (first + 1 >= len(text) or text[first + 1].isspace()):
        first = text.find(" ", first + 1)
    if first < 0:
        return 0, 0
    last = text.rfind(" ", 0, len(text) - 1)
    while text[last + 1].isspace():
        last = text.rfind(" ", 0, last)
    return first, last


def chunks(raw: np.ndarray) -> list[tuple[str, int, int, bytes]]:
    """(text, first and last safe place, hash of the core) of each chunk; no hash without a core."""
    from xxhash import xxh3_128_digest

    out, a = [], 0
    for b in cuts(raw):
        t = raw[a:b].tobytes().decode("utf-8", "replace")
        x, y = core(t)
        out.append((t, x, y, xxh3_128_digest(t[x:y].encode()) if y > x else b""))
        a = b
    return out


def _slot(h: bytes) -> int:
    return int.from_bytes(h[:8], "little") % MAP_BITS + 1


_encoders: dict[str, Encoder] = {}


def encoder(key: str, vocab: Callable[[], str]) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocab())
    return _encoders[key]


class Vocabulary:
    """A tokenizer's file, broadcast once (it is of fixed size)."""

    def __init__(self, spark, path: str):
        text = vocabulary(path)
        self.key = hashlib.sha256(text.encode()).hexdigest()
        self.shared = spark.sparkContext.broadcast(text)

    def encoder(self) -> Encoder:
        return encoder(self.key, lambda: self.shared.value)


def _recurring(docs: DataFrame, text_col: str) -> DataFrame:
    """Slots of the bit map that are set: those of the chunk hashes that occur more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, data = utf8(b.column(0))
            seen: dict[bytes, int] = {}
            for i in range(b.num_rows):
                for _, _, _, h in chunks(data[off[i]:off[i + 1]]):
                    if h:
                        seen[h] = seen.get(h, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([_slot(h) for h in seen], pa.int64()),
                                              pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                             names=["slot", "h", "n"])

    return docs.select(F.col(text_col)).mapInArrow(run, "slot bigint, h binary, n bigint") \
        .groupBy("slot", "h").agg(F.sum("n").alias("n")).filter("n > 1").select("slot")


def _decimals(enc: Encoder) -> list[bytes]:
    if not hasattr(enc, "decimals"):
        enc.decimals = [str(i).encode() for i in range(len(enc.token_bytes))]
    return enc.decimals


def digests(enc: Encoder, packed: bytes) -> tuple[int, str, str]:
    ids = enc.ids(packed).tolist()
    d = _decimals(enc)
    return (len(ids), hashlib.sha256(b",".join([d[i] for i in ids])).hexdigest(),
            hashlib.sha256(enc.decode(ids)).hexdigest())


def outline(enc: Encoder, raw: np.ndarray, shared: Callable[[bytes], bool]) -> list[str | bytes]:
    """A text in order as parts to encode (str) and hashes (bytes) where a recurring core's ids go."""
    text = raw.tobytes().decode("utf-8", "replace")
    if not enc.fast or enc.has_special(text):
        return [text]
    out: list[str | bytes] = []
    window: list[str] = []  # the text since the last safe place taken over, up to the next
    for part, x, y, h in chunks(raw):
        if not h or not shared(h):  # encoded here: no need to cut
            window.append(part)
            continue
        out += ["".join([*window, part[:x]]), h]
        window = [part[y:]]
    return [*out, "".join(window)]


def _recurring_cores(docs: DataFrame, text_col: str, marks) -> DataFrame:
    """(h, core): the distinct cores whose slot is set in the map."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = marks.value
        for b in batches:
            off, data = utf8(b.column(0))
            seen: dict[bytes, str] = {}
            for i in range(b.num_rows):
                for text, x, y, h in chunks(data[off[i]:off[i + 1]]):
                    if h and h not in seen and in_map(m, _slot(h)):
                        seen[h] = text[x:y]
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.string())],
                                             names=["h", "core"])

    return docs.select(F.col(text_col)).mapInArrow(run, "h binary, core string").distinct()


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
           digest: bool = False) -> DataFrame:
    """Per document its id and ``ids`` (array of int); with ``digest`` instead n_tokens and the
    SHA-256 of the ids as decimals (ids_sha256) and of the decoded text (decoded_sha256)."""
    spark = docs.sparkSession
    v = Vocabulary(spark, vocab_path)
    marks = spark.sparkContext.broadcast(bit_map(_recurring(docs, text_col), MAP_BITS))
    kind = docs.schema[id_col].dataType
    value = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())] \
        if digest else [("ids", T.ArrayType(T.IntegerType()))]
    value = [T.StructField(n, t) for n, t in value]
    done = T.StructType([T.StructField("id", kind), *value])
    partial = T.StructType([T.StructField("row", T.LongType()), *done.fields, T.StructField("seq", T.IntegerType()),
                            T.StructField("h", T.BinaryType()), T.StructField("packed", T.BinaryType())])

    def values(enc: Encoder, packed: list[bytes | None]) -> list[pa.Array]:
        if not digest:
            return [pa.array([None if p is None else enc.ids(p).astype(np.int32) for p in packed], pa.list_(pa.int32()))]
        got = [(None, None, None) if p is None else digests(enc, p) for p in packed]
        return [pa.array([g[i] for g in got], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, m = v.encoder(), marks.value
        for b in batches:
            off, data = utf8(b.column(2))
            for lo, hi in blocks(off, 2 << 20):
                at, seq, hs, packs, ready = [], [], [], [], []
                plans = [outline(enc, data[off[i]:off[i + 1]], lambda h: in_map(m, _slot(h))) for i in range(lo, hi)]
                ids = iter(enc.many([p for pieces in plans for p in pieces if isinstance(p, str)]))
                for i, pieces in enumerate(plans, lo):
                    for j, p in enumerate(pieces):
                        packed = next(ids) if isinstance(p, str) else None
                        at.append(i)
                        seq.append(j if len(pieces) > 1 else -1)
                        hs.append(None if isinstance(p, str) else p)
                        packs.append(packed if len(pieces) > 1 else None)
                        ready.append(packed if len(pieces) == 1 else None)
                rows_ = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows_), b.column(1).take(rows_), *values(enc, ready), pa.array(seq, pa.int32()),
                     pa.array(hs, pa.binary()), pa.array(packs, pa.binary())], names=partial.fieldNames())

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row, ident, parts = v.encoder(), None, None, []
        ids, packed = [], []

        def flush(least: int) -> Iterator[pa.RecordBatch]:
            if len(ids) >= least and ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), *values(enc, packed)], names=done.fieldNames())
                ids.clear()
                packed.clear()

        id_type = None
        for b in batches:
            id_type = b.schema.field("id").type
            for r, i, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if r != row:
                    if row is not None:
                        ids.append(ident)
                        packed.append(b"".join(parts))
                        yield from flush(512)
                    row, ident, parts = r, i, []
                parts.append(p)
        if row is not None:
            ids.append(ident)
            packed.append(b"".join(parts))
            yield from flush(1)

    # one pass over the texts: ready documents come out finished, the others as pieces with holes
    begun = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                               F.col(text_col).alias("text")).mapInArrow(begin, partial))

    def encode_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = v.encoder()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(enc.many(b.column(1).to_pylist()), pa.binary())],
                                             names=["h", "got"])

    once = _recurring_cores(docs, text_col, marks).mapInArrow(encode_cores, "h binary, got binary")
    pieces = begun.filter("seq >= 0").select("row", "id", "seq", "h", "packed")
    filled = pieces.filter("h is not null").join(once, "h").select("row", "id", "seq", F.col("got").alias("packed"))
    given = pieces.filter("h is null").select("row", "id", "seq", "packed")
    whole = filled.unionByName(given).repartition("row").sortWithinPartitions("row", "seq") \
                  .select("row", "id", "packed").mapInArrow(assemble, done)
    ready = begun.filter("seq < 0").select("id", *[f.name for f in value])
    return ready.unionByName(whole).withColumnRenamed("id", id_col)
