"""Arrow and numpy helpers shared by the text operators.

Texts reach Python as Arrow string columns.  The helpers below look at the
UTF-8 bytes in the Arrow buffer itself, so no Python string is made per row,
and they work through a batch in blocks of whole rows of about
``BLOCK_BYTES`` bytes, so the temporaries stay small whatever a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets as int64 of length n + 1, bytes) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    if data is None:
        return off - off[0] if len(off) else np.zeros(1, np.int64), np.zeros(0, np.uint8)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]]
    return off - off[0], raw


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``limit`` bytes, or of one row."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


def byte_values(fold: bytes, seed: int) -> np.ndarray:
    """A random 64-bit value per byte; bytes that ``fold`` maps together share one."""
    table = np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, 256, dtype=np.uint64)
    return table[np.frombuffer(fold, np.uint8)]


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = max(n, _SEGMENT + 4096)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


class Words:
    """Words of a block of rows: byte starts and ends, a 64-bit hash, the first word of each row."""

    __slots__ = ("starts", "ends", "hashes", "first")

    def __init__(self, starts, ends, hashes, first):
        self.starts, self.ends, self.hashes, self.first = starts, ends, hashes, first

    @property
    def row_end(self) -> np.ndarray:
        """Per word, the index after the last word of its row."""
        return np.repeat(self.first[1:], np.diff(self.first))


def words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray, values: np.ndarray) -> Words:
    """Maximal runs of bytes with ``is_word``; a run ends with its row."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(0, np.uint64), np.zeros(len(off), np.int64))
    m = is_word[data]
    s, e = m.copy(), m.copy()
    s[1:] &= ~m[:-1]
    e[:-1] &= ~m[1:]
    heads = off[:-1][off[:-1] < n]
    s[heads] = m[heads]
    tails = off[1:][off[1:] > 0] - 1
    e[tails] = m[tails]
    starts, ends = np.flatnonzero(s), np.flatnonzero(e) + 1
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            base = starts[i]
            j = max(i + 1, int(np.searchsorted(starts, base + _SEGMENT)))
            top = ends[j - 1] - base
            up, down = _power(int(top) + 1)
            p = np.empty(top + 1, np.uint64)
            p[0] = 0
            np.cumsum(values[data[base:base + top]] * up[:top], dtype=np.uint64, out=p[1:])
            a, b = starts[i:j] - base, ends[i:j] - base
            hashes[i:j] = (p[b] - p[a]) * down[a] + (b - a).astype(np.uint64)
            i = j
        hashes = mix(hashes)
    return Words(starts, ends, hashes, np.searchsorted(starts, off))


def gram_sums(h: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Per size k, the hash of the k words from each position (positions with fewer words are absent)."""
    out, acc, c = {}, np.zeros(len(h), np.uint64), 1
    with np.errstate(over="ignore"):
        for j in range(max(sizes, default=0)):
            if j >= len(h):
                acc = np.zeros(0, np.uint64)
            else:
                acc = acc[:len(h) - j] + h[j:] * np.uint64(c)
            c = c * _BASE % (1 << 64)
            if j + 1 in sizes:
                out[j + 1] = mix(acc)
    return out


def rows(schema: pa.Schema, arrays: list) -> pa.RecordBatch:
    """A record batch of the given schema from arrays or lists."""
    return pa.RecordBatch.from_arrays(
        [a if isinstance(a, pa.Array) and a.type == f.type else pa.array(a).cast(f.type) if isinstance(a, np.ndarray)
         else a.cast(f.type) if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema)],
        schema=schema)
