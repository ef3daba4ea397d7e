"""Vectorised text helpers that run inside Arrow tasks.

Everything here works on Arrow string columns in chunks of about a megabyte,
so that memory stays bounded by the longest single text, not by the batch.
A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``; A-Z count as
a-z. Hashes are 64 bits; a set of a billion words meets a single collision
with a chance of a few per cent, and one collision changes one count by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_BASE = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on an array of unsigned 64-bit integers."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def const(n: int) -> np.uint64:
    """A well-spread 64-bit constant for a small number."""
    return mix(np.array([n + 1], np.uint64) * _GOLD)[0]


#: The value of each byte in word hashes: A-Z fold to a-z.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_EXACT = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """At least ``n`` powers of an odd base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        out = np.full(max(n, 2 * len(_powers), 1024), _BASE, np.uint64)
        out[0] = 1
        _powers = np.multiply.accumulate(out)
    return _powers


def string_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if not (pa.types.is_large_string(column.type) or pa.types.is_string(column.type)):
        column = column.cast(pa.string())
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off.astype(np.int64) - int(off[0])


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a longer text is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


@dataclass
class Words:
    """Words of a range of rows: hash, place in the chunk's bytes, and row."""

    hash: np.ndarray    # uint64
    start: np.ndarray   # byte offsets in ``data``
    end: np.ndarray
    first: np.ndarray   # first word of each row; one longer than the rows
    data: np.ndarray
    offsets: np.ndarray  # byte offsets of the rows in ``data``
    check: np.ndarray | None = None  # a second hash, where asked for


def words(data: np.ndarray, offsets: np.ndarray, check: bool = False, fold: bool = True) -> Words:
    """The words of every row; rows end words. Without ``fold`` A-Z differ from a-z."""
    rows = len(offsets) - 1
    inside = ~_SPACE[data]
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    if len(data):
        after[:-1] = inside[1:]
        last = offsets[1:][offsets[1:] > 0] - 1
        after[last] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offsets).astype(np.int64)
    if not len(start):
        none = np.zeros(0, np.uint64)
        return Words(none, start, end, first, data, offsets, none)
    size = end - start
    total = int(size.sum())
    begin = np.zeros(len(start), np.int64)
    np.cumsum(size[:-1], out=begin[1:])
    place = np.arange(total) - np.repeat(begin, size)
    value = (_BYTE if fold else _EXACT)[data[inside]]
    power = powers(int(size.max()))[place]
    second = np.add.reduceat((value ^ (value >> _S27)) * (power ^ (power >> _S31)), begin) if check else None
    value = value * power
    h = mix(np.add.reduceat(value, begin) + size.astype(np.uint64) * _GOLD)
    assert rows == len(first) - 1
    return Words(h, start, end, first, data, offsets, second)


def word_chunks(column) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of an Arrow string column, piece by piece."""
    data, offsets = string_buffers(column)
    for a, b in chunks(offsets):
        yield a, b, words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words of one text; a shorter text is one
    shingle of all its words; no words, no shingle."""
    n = len(h)
    if n == 0:
        return h
    size = min(size, n)
    out = h[: n - size + 1] * const(size)
    for k in range(1, size):
        out = (out ^ (out >> _S31)) * _BASE + h[k: n - size + 1 + k]
    return mix(out)


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, kind))


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unicode code points of UTF-8 rows and the rows' offsets in them."""
    try:
        cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
    except UnicodeDecodeError:  # not text; its bytes stand for characters
        return data.astype(np.uint32), offsets
    if len(cp) == len(data):
        return cp, offsets
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return cp, lead[offsets]


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def lowered(column):
    """The column in lower case, as Arrow's kernel has it."""
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.utf8_lower(column)


def gram_slots(cp: np.ndarray, orders: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each order: the slot (below 2**bits) of the character n-gram that
    starts at each position; white space characters are all one."""
    c = cp.astype(np.uint64)
    c[(c <= 32) | (c == 0xA0)] = 32
    c = (c + np.uint64(1)) * _GOLD
    out, h = {}, c
    for n in range(1, max(orders) + 1):
        if n > 1:
            h = h[:-1] * _BASE + (c[n - 1:] ^ (c[n - 1:] >> _S31)) if len(h) > 1 else h[:0]
        if n in orders:
            x = (h ^ (h >> _S31)) * _M1
            out[n] = (x >> np.uint64(64 - bits)).astype(np.int32)
    return [out[n] for n in orders]


def row_slots(column, orders: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(row, its code points, its slots by order) for every row of a column."""
    data, offsets = string_buffers(lowered(column))
    for a, b in chunks(offsets):
        cp, off = code_points(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        slots = gram_slots(cp, orders, bits)
        for r in range(b - a):
            lo, hi = off[r], off[r + 1]
            yield a + r, cp[lo:hi], [s[lo:max(lo, hi - n + 1)] for s, n in zip(slots, orders)]


class Distinct:
    """Distinct slots of one row after another, without sorting."""

    def __init__(self, bits: int):
        self.last = np.full(1 << bits, -1, np.int64)
        self.at = 0

    def __call__(self, slots: np.ndarray) -> np.ndarray:
        place = np.arange(self.at, self.at + len(slots))
        self.at += len(slots)
        self.last[slots] = place
        return slots[self.last[slots] == place]
