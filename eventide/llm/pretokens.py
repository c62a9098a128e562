"""Byte-level BPE of whole blocks of texts as array operations.

``starts`` cuts texts of plain characters (ASCII without most control
characters, Latin letters up to U+024F) into the pre-tokens of the byte-level
pattern (contractions; letters, digits or other signs with a space before
them; white space) by comparing neighbouring bytes.  ``Merges`` applies the merge
rules to many pre-tokens at once: each round merges every pre-token's pair of the least
rank (the leftmost, if several), as the library does one by one.

``Pretokens`` holds what it has encoded in a cache of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

ENTRIES, STORED = 600_000, 8_000_000  # pre-tokens and ids that the cache holds before it starts anew
LONG = 64  # bytes; longer pre-tokens go to the library and stay out of the cache

_NOTHING = 1 << 30  # no id
_ODD, _LETTER, _DIGIT, _SIGN, _SPACE = 0, 1, 2, 3, 4
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[9, 10, 32]] = _SPACE
_CLASS[0xC3:0xCA] = _LETTER  # first bytes of U+00C0 to U+027F
_CLASS[0x80:0xC0] = _LETTER  # the bytes after them


def classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte, and the places of those that aren't plain."""
    c = _CLASS[data]
    odd = c == _ODD
    wide = data >= 0x80
    if wide.any():
        at = np.flatnonzero(wide)
        first, second = data[at], data[np.minimum(at + 1, len(data) - 1)]
        # multiplication and division signs, and U+0250 on
        bad = ((first == 0xC3) & ((second == 0x97) | (second == 0xB7))) | ((first == 0xC9) & (second > 0x8F))
        odd[at[bad]] = True
    return c, np.flatnonzero(odd)


def starts(data: np.ndarray, off: np.ndarray, c: np.ndarray) -> np.ndarray:
    """First byte of every pre-token of rows of plain bytes."""
    n = len(data)
    heads = off[:-1][off[:-1] < off[1:]]
    new = np.ones(n, bool)
    new[1:] = c[1:] != c[:-1]
    new[heads] = True  # runs of one class
    space = c == _SPACE
    run = np.flatnonzero(new)
    ends = np.append(run[1:], n)
    white = space[run]
    a, b = run[white], ends[white]
    row_end = np.zeros(n + 1, bool)
    row_end[off[1:]] = True
    inner = ~row_end[b]  # something follows in the row: the run's last character is for itself, or for what follows
    a, b = a[inner], b[inner]
    new[b - 1] = True
    new[b[data[b - 1] == 32]] = False
    # contractions: an apostrophe that is a pre-token's first and only sign, and lower-case letters
    quote = np.flatnonzero(data == 39)
    if len(quote):
        at = np.concatenate((data, np.zeros(3, np.uint8)))
        stop = np.searchsorted(off, quote, side="right")  # the row's end
        left = off[np.minimum(stop, len(off) - 1)] - quote
        one, two = at[quote + 1], at[quote + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (left > 1)
        pair = (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)) & (left > 2)
        size = np.where(short, 2, np.where(pair, 3, 0))
        # not in a longer run of signs, nor after a space that belongs to it
        ok = (size > 0) & new[quote]
        quote, size, left = quote[ok], size[ok], left[ok]
        new[quote + 1] = False
        rest = left > size
        new[(quote + size)[rest]] = True
    return np.flatnonzero(new)


class Merges:
    """The merge rules as a hash table of pairs of ids."""

    def __init__(self, pairs: list[tuple[int, int, int]], byte_ids: np.ndarray):
        """pairs: (left, right, merged) in the order of their ranks."""
        self.byte_ids = byte_ids.astype(np.int32)
        size = 1 << max(4, (8 * max(1, len(pairs)) - 1).bit_length())
        self._shift = np.uint64(64 - size.bit_length() + 1)
        self._mask = size - 1
        self._keys = np.full(size, -1, np.int64)
        self._first: np.ndarray | None = None  # ranks of pairs of bytes
        self._ranks = np.zeros(size, np.int32)
        self.none = np.int32(len(pairs))
        self.merged = np.array([m for _, _, m in pairs] + [0], np.int32)
        keys = np.array([(a << 32) | b for a, b, _ in pairs], np.int64)
        at, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):  # the first of those that meet in a free slot stays, the others go on
            free = self._keys[at[todo]] < 0
            slot, first = np.unique(at[todo][free], return_index=True)
            put = todo[free][first]
            self._keys[slot], self._ranks[slot] = keys[put], put
            todo = np.setdiff1d(todo, put)
            at[todo] = (at[todo] + 1) & self._mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``none`` for those without a rule."""
        keys = (a.astype(np.int64) << 32) | b
        at = self._slots(keys)
        got = self._keys[at]
        out = np.where(got == keys, self._ranks[at], self.none)
        todo = np.flatnonzero((got != keys) & (got >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self._mask
            got = self._keys[at[todo]]
            hit = got == keys[todo]
            out[todo[hit]] = self._ranks[at[todo[hit]]]
            todo = todo[~hit & (got >= 0)]
        return out

    def _of_bytes(self) -> np.ndarray:
        if self._first is None:
            a = np.repeat(np.arange(256), 256)
            self._first = self.ranks(self.byte_ids[a], self.byte_ids[np.tile(np.arange(256), 256)]).reshape(256, 256)
        return self._first

    def _merge(self, raw: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Rows of bytes (those ``held``) as ids, ``_NOTHING`` elsewhere, merged as far as the rules go.

        Ids stay where their first byte stands; each place knows the next and the previous one in use."""
        n, wide = raw.shape
        end = n * wide  # stands for the places before and after a row
        t = np.append(np.where(held, self.byte_ids[raw], _NOTHING).ravel(), _NOTHING).astype(np.int32)
        r = np.full(end + 1, self.none, np.int32)
        rows = r[:end].reshape(n, wide)
        if wide > 1:
            rows[:, :-1] = np.where(held[:, 1:], self._of_bytes()[raw[:, :-1], raw[:, 1:]], self.none)
        place = np.arange(end).reshape(n, wide)
        after, before = np.full(end + 1, end), np.full(end + 1, end)
        after[:end].reshape(n, wide)[:, :-1] = np.where(held[:, 1:], place[:, 1:], end)
        before[:end].reshape(n, wide)[:, 1:] = place[:, :-1]
        live = np.arange(n)
        while len(live):
            at = live * wide + rows[live].argmin(axis=1)
            best = r[at]
            on = best < self.none
            if not on.all():
                live, at, best = live[on], at[on], best[on]
            gone = after[at]
            nxt, last = after[gone], before[at]
            t[at], t[gone], r[gone] = self.merged[best], _NOTHING, self.none
            after[at], before[nxt] = nxt, at
            got = self.ranks(np.concatenate((t[at], t[last])), np.concatenate((t[nxt], t[at])))
            r[at], r[last] = got[:len(at)], got[len(at):]
        return t[:end].reshape(n, wide)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, none of them empty, one after another; number of each)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(size) - size
        number = np.zeros(len(words), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(size, kind="stable")
        lo = 0
        while lo < len(order):
            wide = int(size[order[lo]])
            wide = max(wide, 4) if wide <= 4 else wide + 1
            hi = min(int(np.searchsorted(size[order], wide, side="right")), lo + (1 << 16))
            rows = order[lo:hi]
            cols = np.arange(wide)[None, :]
            held = cols < size[rows][:, None]
            t = self._merge(raw[np.minimum(first[rows][:, None] + cols, len(raw) - 1)], held)
            keep = t != _NOTHING
            number[rows] = keep.sum(axis=1)
            parts.append((rows, t[keep]))
            lo = hi
        out = np.empty(int(number.sum()), np.int32)
        at = np.cumsum(number) - number
        for rows, ids in parts:
            k = number[rows]
            out[np.repeat(at[rows] - (np.cumsum(k) - k), k) + np.arange(len(ids))] = ids
        return out, number


class Pretokens:
    """Encodes blocks of plain texts by their pre-tokens."""

    def __init__(self, merges: Merges, library, dtype: np.dtype):
        self.merges, self.library, self.dtype = merges, library, dtype
        self._reset()

    def _reset(self) -> None:
        self._known: dict[bytes, int] = {}
        self._ids = np.empty(1 << 16, self.dtype)
        self._ends = np.zeros(1 << 14, np.int64)  # of the entries' ids; the first entry begins at 0
        self._n = 0

    def _add(self, ids: np.ndarray, number: np.ndarray) -> int:
        """Append entries; returns the first one's number."""
        first, n = self._n, self._n + len(number)
        at = int(self._ends[first - 1]) if first else 0
        ends = at + np.cumsum(number)
        while n > len(self._ends):
            self._ends = np.concatenate((self._ends, np.zeros_like(self._ends)))
        while at + len(ids) > len(self._ids):
            self._ids = np.concatenate((self._ids, np.empty_like(self._ids)))
        self._ends[first:n], self._ids[at:at + len(ids)] = ends, ids
        self._n = n
        return first

    def _entries(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        out = list(map(known.get, words))
        new = [i for i, e in enumerate(out) if e is None]
        short = [i for i in new if len(words[i]) <= LONG]
        if short:
            first = self._add(*self.merges.encode([words[i] for i in short]))
            for e, i in enumerate(short, first):
                out[i] = e
                known[words[i]] = e
        for i in new:
            if out[i] is None:
                ids = np.frombuffer(self.library(words[i].decode()), self.dtype)
                out[i] = self._add(ids, np.array([len(ids)]))
        return np.array(out, np.int64)

    def encode(self, data: np.ndarray, off: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, offsets of the rows in them)."""
        if len(self._known) > ENTRIES or (self._n and self._ends[self._n - 1] > STORED):
            self._reset()
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(off), np.int64)
        at = starts(data, off, c)
        cut = np.append(at, len(data)).astype(np.int32)
        tokens = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(cut), pa.py_buffer(data)])
        coded = tokens.dictionary_encode()
        _, where, held = coded.dictionary.buffers()
        where = np.frombuffer(where, np.int32)[:len(coded.dictionary) + 1].tolist()
        held = held.to_pybytes()
        entry = self._entries([held[a:b] for a, b in zip(where, where[1:])])
        end = self._ends[entry]
        begin = np.where(entry > 0, self._ends[entry - 1], 0)
        index = coded.indices.to_numpy()
        number = (end - begin)[index]
        total = np.concatenate(([0], np.cumsum(number)))
        ids = self._ids[np.repeat(begin[index] - total[:-1], number) + np.arange(total[-1])]
        return ids, total[np.searchsorted(at, off)]
