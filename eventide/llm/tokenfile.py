"""Token files: one wavelet matrix per shard, compressed, with rank and select.

``write`` encodes documents in ascending id order (an end id after each) and
packs runs of whole documents of about ``SHARD_TOKENS`` tokens into files.  The
table is range-partitioned by id, so each task writes a consecutive run; a file
is one binary value of a Parquet table in a shared folder, which is the only
way for a task to write to whatever store Spark writes to.

A file holds, after a header and the documents' lengths, one bit plane per bit
of a token, from the highest down; between planes the tokens are stably
partitioned by that bit (Claude, Navarro and Ordonez, 2015).  Planes are cut
into blocks of ``BLOCK`` bits, each compressed by itself, with the number of
ones before it: access, counting and occurrence lookup decompress only the
blocks that they touch.

Defined cases: null is an empty text and holds the end id alone; equal ids are
ordered by their texts' hash; an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import blocks, utf8
from .bpe import Vocabulary
from .staging import staged

SHARD_TOKENS = 1 << 20
BLOCK = 1 << 16
_MAGIC = b"WVM1"


def build(ids: np.ndarray, lengths: np.ndarray, bits: int) -> bytes:
    """The file of a shard: its tokens, cut into documents of the given lengths."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    a = np.ascontiguousarray(ids, np.uint16 if bits <= 16 else np.uint32)
    n = len(a)
    blocks = -(-n // BLOCK)
    docs = pack(np.asarray(lengths, "<u8").tobytes())
    head = [_MAGIC, struct.pack("<BQQQ", bits, n, len(lengths), len(docs)), docs]
    body, place = [], 0
    for level in range(bits - 1, -1, -1):
        one = (a & a.dtype.type(1 << level)) != 0
        packed = np.packbits(one, bitorder="little").tobytes()
        count = np.bitwise_count(np.frombuffer(packed, np.uint8))
        ones = np.add.reduceat(count, np.arange(0, len(count), BLOCK // 8), dtype=np.int64) if n else np.zeros(0, np.int64)
        before = np.concatenate(([0], np.cumsum(ones)))
        places = [place]
        for b in range(blocks):
            raw = packed[b * BLOCK // 8:(b + 1) * BLOCK // 8]
            small = pack(raw)
            small = small if len(small) < len(raw) else raw
            body.append(small)
            place += len(small)
            places.append(place)
        head += [before.astype("<u8").tobytes(), np.asarray(places, "<u8").tobytes()]
        a = np.concatenate((np.compress(~one, a), np.compress(one, a)))
    return b"".join(head + body)


class Shard:
    """Reads a file without unpacking more than is asked for."""

    def __init__(self, raw: bytes):
        import zstandard

        self._unpack = zstandard.ZstdDecompressor().decompress
        if raw[:4] != _MAGIC:
            raise ValueError("not a token file")
        self.bits, self.n, docs, size = struct.unpack_from("<BQQQ", raw, 4)
        at = 4 + struct.calcsize("<BQQQ")
        self.lengths = np.frombuffer(self._unpack(raw[at:at + size]), "<u8").astype(np.int64)
        at += size
        self.blocks = -(-self.n // BLOCK)
        row = 8 * (self.blocks + 1)
        self.before, self.places = [], []
        for _ in range(self.bits):
            self.before.append(np.frombuffer(raw, "<u8", self.blocks + 1, at).astype(np.int64))
            self.places.append(np.frombuffer(raw, "<u8", self.blocks + 1, at + row).astype(np.int64))
            at += 2 * row
        self._raw, self._body = raw, at
        self.zeros = [self.n - int(b[-1]) for b in self.before]
        self._last: tuple[int, int] | None = None
        self._bytes = np.zeros(0, np.uint8)

    def _block(self, plane: int, b: int) -> np.ndarray:
        if self._last != (plane, b):
            lo, hi = self._body + int(self.places[plane][b]), self._body + int(self.places[plane][b + 1])
            want = (min(self.n, (b + 1) * BLOCK) - b * BLOCK + 7) // 8
            raw = self._raw[lo:hi]
            self._bytes = np.frombuffer(raw if len(raw) == want else self._unpack(raw), np.uint8)
            self._last = (plane, b)
        return self._bytes

    def bit(self, plane: int, i: int) -> int:
        return int(self._block(plane, i // BLOCK)[i % BLOCK >> 3]) >> (i & 7) & 1

    def rank1(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        b, r = divmod(i, BLOCK)
        if not r:
            return int(self.before[plane][b])
        x = self._block(plane, b)
        full = int(np.bitwise_count(x[:r >> 3]).sum(dtype=np.int64))
        part = int(x[r >> 3]) & ((1 << (r & 7)) - 1) if r & 7 else 0
        return int(self.before[plane][b]) + full + part.bit_count()

    def select(self, plane: int, one: int, k: int) -> int:
        """Place of the k-th (from 0) bit of a plane that is ``one``."""
        count = self.before[plane] if one else np.minimum(np.arange(self.blocks + 1) * BLOCK, self.n) - self.before[plane]
        b = int(np.searchsorted(count, k, side="right")) - 1
        bits = np.unpackbits(self._block(plane, b), bitorder="little")[:min(self.n, (b + 1) * BLOCK) - b * BLOCK]
        return b * BLOCK + int(np.flatnonzero(bits == one)[k - int(count[b])])

    def _down(self, plane: int, one: int, i: int) -> int:
        r = self.rank1(plane, i)
        return self.zeros[plane] + r if one else i - r

    def __getitem__(self, i: int) -> int:
        """The token at place i."""
        token = 0
        for plane in range(self.bits):
            one = self.bit(plane, i)
            token = token << 1 | one
            i = self._down(plane, one, i)
        return token

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for plane in range(self.bits):
            one = token >> (self.bits - 1 - plane) & 1
            lo, hi = self._down(plane, one, lo), self._down(plane, one, hi)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often a token stands in [lo, hi)."""
        if token >> self.bits:
            return 0
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def find(self, token: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of a token; -1 if there are fewer."""
        if token >> self.bits or k < 0:
            return -1
        a, b = self._range(token, 0, self.n)
        if k >= b - a:
            return -1
        i = a + k
        for plane in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - plane) & 1
            i = self.select(plane, one, i - self.zeros[plane] if one else i)
        return i

    def tokens(self) -> np.ndarray:
        """All tokens in order, plane by plane from the lowest bit up."""
        cur = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for plane in range(self.bits - 1, -1, -1):
            packed = np.concatenate([self._block(plane, b) for b in range(self.blocks)]) if self.blocks else np.zeros(0, np.uint8)
            one = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            out = np.empty_like(cur)
            z = self.zeros[plane]
            out[~one] = cur[:z]
            out[one] = cur[z:] | cur.dtype.type(1 << (self.bits - 1 - plane))
            cur = out
        return cur


def files(docs: DataFrame, vocab_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(part, seq, start, n_tokens, ids, file): the files in order of (part, seq); start counts from the part's first token."""
    v = Vocabulary(docs.sparkSession, vocab_path)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(kind)), T.StructField("file", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = v.encoder(), TaskContext.get().partitionId()
        size = len(enc.token_bytes)
        bits = max(size - 1, end_id).bit_length()
        end = np.array([end_id], enc.dtype).tobytes()
        ids, packed, lengths, held = [], [], [], 0
        seq = start = 0

        def shard(id_type) -> pa.RecordBatch:
            file = build(np.frombuffer(b"".join(packed), enc.dtype), np.array(lengths), bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([file], pa.binary())],
                names=schema.fieldNames())

        id_type = None
        for b in batches:
            id_type = b.column(0).type
            off, data = utf8(b.column(1))
            keys = b.column(0).to_pylist()
            for lo, hi in blocks(off, 2 << 20):
                got = enc.block(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                for key, p in zip(keys[lo:hi], got):
                    ids.append(key)
                    packed += (p, end)
                    lengths.append(len(p) // enc.dtype.itemsize + 1)
                    held += lengths[-1]
                    if held >= shard_tokens:
                        yield shard(id_type)
                        start, seq = start + held, seq + 1
                        ids, packed, lengths, held = [], [], [], 0
        if ids:
            yield shard(id_type)

    order = [F.col("i"), F.xxhash64("t")]
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")) \
        .repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def contents(written: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, start, n_tokens and ids_crc32."""
    totals = sorted((r["part"], r["n"]) for r in written.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base, at = {}, 0  # a number per range partition
    for part, n in totals:
        base[part], at = at, at + n
    kind = written.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                s = Shard(b.column("file")[i].as_py())
                t = s.tokens().astype("<u4")
                cut = np.concatenate(([0], np.cumsum(s.lengths)))
                first = base[b.column("part")[i].as_py()] + b.column("start")[i].as_py()
                crc = [zlib.crc32(t[x:y].tobytes()) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids")[i].values, pa.array(first + cut[:-1], pa.int64()),
                     pa.array(s.lengths, pa.int64()), pa.array(crc, pa.int64())], names=schema.fieldNames())

    return written.select("part", "start", "ids", "file").mapInArrow(run, schema)


def write(docs: DataFrame, path: str, vocab_path: str, end_id: int, **options) -> None:
    """Write the files of ``docs`` below ``path``."""
    files(docs, vocab_path, end_id, **options).write.parquet(path)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    return contents(spark.read.parquet(path), id_col)


def round_trip(docs: DataFrame, vocab_path: str, end_id: int = 2, **options) -> DataFrame:
    """Write the files into the session's shared folder and read them back."""
    return contents(staged(files(docs, vocab_path, end_id, **options)), options.get("id_col", "doc_id"))
