"""Periodic runs: maximal stretches of words that repeat with a smallest period.

*Block convolution.* At each dyadic scale of blocks of B words, the sum of the
squared differences between a block and the words at every place of the windows
that follow it comes from a convolution, computed exactly over the integers by a
number-theoretic transform; where it is zero the block occurs again. Scale B
answers for the distances 2B to 4B - 1 (the first scale for all smaller ones
too): a run of period d repeats itself at distance d over at least d words,
which hold a whole block of that scale, so every run is met.

*Seeds.* A distance at which a block occurs again seeds an extension: adjacent
blocks of one distance are one seed, which grows word by word to both sides. The
stretch is a run if it is long enough. Within a run of period q every multiple
of q is such a distance too; those seeds are told by the run that is already
known and dropped, so that work follows the runs and not the pairs of copies.

Word numbers are taken modulo a bound that keeps the sum under the modulus of the
transform; that can only add seeds, which the comparison of words itself rejects.

Texts of a batch are worked on in the order of their size, many short ones at a
time; a text of n words takes O(n) memory and O(n log(n)**2) time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_LENGTH = 12
#: Bytes of text that are worked on together, and cells of a transform.
CHUNK_BYTES = 1 << 19
SLAB_CELLS = 1 << 15

#: (prime, a primitive root, the largest power of two that divides prime - 1, stages between reductions).
#: Residues are kept as whole numbers in doubles, between -prime / 2 and prime / 2 after a reduction, so that
#: every product stays below 2**53 and the arithmetic is exact.
_FIELDS = ((23068673, 3, 1 << 21, 4), (167772161, 3, 1 << 25, 0))
MOST_BLOCK = 1 << 24
_SMALL = 64


# ---- the transform ---------------------------------------------------------------

class Field:
    """Whole numbers modulo a prime that has roots of unity of order ``size``."""

    def __init__(self, size: int):
        self.prime, self.root, _, self.lazy = next(x for x in _FIELDS if size <= x[2])
        self.inverse = 1.0 / self.prime

    def reduced(self, x: np.ndarray) -> np.ndarray:
        """In place."""
        q = x * self.inverse
        np.rint(q, out=q)
        q *= self.prime
        x -= q
        return x

    def centred(self, x: int) -> int:
        return x - self.prime if x > self.prime // 2 else x

    def twiddles(self, size: int, inverse: bool) -> np.ndarray:
        """The first size / 2 powers of a root of unity of order ``size``."""
        key = (self.prime, size, inverse)
        if key not in _twiddles:
            w = pow(self.root, (self.prime - 1) // size, self.prime)
            w = pow(w, -1, self.prime) if inverse else w
            out = np.ones(max(1, size // 2))
            have = 1
            while have < len(out):  # each step doubles the table
                more = min(have, len(out) - have)
                out[have:have + more] = self.reduced(out[:more] * self.centred(pow(w, have, self.prime)))
                have += more
            _twiddles[key] = out
        return _twiddles[key]

    def _stages(self, a: np.ndarray, size: int, least: int, inverse: bool) -> np.ndarray:
        """Butterflies of spans ``size`` down to ``least`` (up, for the inverse) of [groups, size, rest] numbers."""
        spans = [1 << k for k in range(least.bit_length() - 1, size.bit_length())]
        for k, span in enumerate(spans if inverse else spans[::-1]):
            w = self.twiddles(span, inverse)[:, None]
            v = a.reshape(-1, 2, span // 2, a.shape[-1])
            x, y = v[:, 0], v[:, 1]
            out = np.empty_like(v)
            if inverse:  # sums grow by half a prime a stage
                y = self.reduced(y * w)
                np.add(x, y, out=out[:, 0])
                np.subtract(x, y, out=out[:, 1])
            else:  # sums double from stage to stage
                np.add(x, y, out=out[:, 0])
                y = x - y
                if not self.lazy:
                    self.reduced(y)
                y *= w
                out[:, 1] = self.reduced(y)
            a = out.reshape(a.shape)
            if not self.lazy or not inverse and k % self.lazy == self.lazy - 1:
                self.reduced(a)
        return a

    def transform(self, a: np.ndarray) -> np.ndarray:
        """The number-theoretic transform of every row, in bit-reversed order."""
        rows, size = a.shape
        if size > _SMALL:
            a = self.reduced(self._stages(a.reshape(rows, size, 1), size, 2 * _SMALL, False))
        small = min(size, _SMALL)
        turned = np.ascontiguousarray(a.reshape(-1, small).T)
        turned = self.reduced(self._stages(turned[None], small, 2, False)[0])
        return np.ascontiguousarray(turned.T).reshape(rows, size)

    def inverse_transform(self, a: np.ndarray) -> np.ndarray:
        """Of reduced rows in bit-reversed order; ``transform`` undone."""
        rows, size = a.shape
        small = min(size, _SMALL)
        turned = np.ascontiguousarray(a.reshape(-1, small).T)
        turned = self.reduced(self._stages(turned[None], small, 2, True)[0])
        a = np.ascontiguousarray(turned.T).reshape(rows, size)
        if size > _SMALL:
            a = self.reduced(self._stages(a.reshape(rows, size, 1), size, 2 * _SMALL, True)).reshape(rows, size)
        a *= self.centred(pow(size, -1, self.prime))
        return self.reduced(a)


_twiddles: dict[tuple, np.ndarray] = {}


@lru_cache(maxsize=None)
def _negated(size: int) -> np.ndarray:
    """Where, in bit-reversed order, the coefficient of -k stands for that of k."""
    at = np.zeros(1, np.int64)
    while len(at) < size:
        at = np.concatenate((2 * at, 2 * at + 1))  # bit-reversed order of twice as many
    place = np.empty(size, np.int64)
    place[at] = np.arange(size)
    return place[-at % size]


def occurrences(number: np.ndarray, block: int, windows: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, distances) at which a block of ``block`` words may occur again.

    Blocks start at multiples of ``block``; window k holds the distances from
    k * block to (k + 1) * block - 1. All true repetitions are among those given.
    """
    size = 2 * block
    field = Field(size)
    bound = int(((field.prime - 1) // block) ** 0.5)  # block * (bound - 1)**2 < prime
    count = -(-len(number) // block)
    reach = windows[-1] + 2
    step = max(8, SLAB_CELLS // size)
    negated = _negated(size)
    for m0 in range(0, count, step):
        m1 = min(count, m0 + step)
        flat = np.zeros((m1 - m0 + reach) * block)
        here = number[m0 * block:(m1 + reach) * block]
        flat[:len(here)] = here % bound
        padded = np.zeros((m1 - m0 + reach, size))
        padded[:, :block] = flat.reshape(-1, block)
        f = field.transform(padded)
        # a window is its first block and, half a turn on, its second: the sign of odd coefficients,
        # which are the second half in bit-reversed order
        window = f[:-1].copy()
        window[:, :block] += f[1:, :block]
        window[:, block:] -= f[1:, block:]
        field.reduced(window)
        pattern = f[:m1 - m0, negated]
        square = np.zeros(len(flat) + 1)
        np.cumsum(flat * flat, out=square[1:])
        own = np.diff(square[::block])[:m1 - m0, None]
        for k in windows:
            cross = field.inverse_transform(field.reduced(pattern * window[k:k + m1 - m0]))[:, :block]
            at = k * block
            other = (square[at + block:at + block + (m1 - m0) * block]
                     - square[at:at + (m1 - m0) * block]).reshape(-1, block)
            # the sum of squared differences, exact as it is below the modulus
            at, shift = np.nonzero(field.reduced(own + other - 2 * cross) == 0)
            yield (at + m0) * block, k * block + shift


# ---- runs ------------------------------------------------------------------------

def _reach(number: np.ndarray, at: np.ndarray, d: np.ndarray, way: int) -> np.ndarray:
    """How many words from ``at`` on (or back, for way -1) equal the word ``d`` further on.
    The first and the last number of the array occur once, so that no comparison runs over its ends."""
    grown = np.zeros(len(at), np.int64)
    alive = np.arange(len(at))
    width, top = 8, len(number) - 1
    while len(alive):
        offs = np.arange(width)
        i = at[alive, None] + way * (grown[alive, None] + offs[None, :])
        same = number[np.clip(i, 0, top)] == number[np.clip(i + d[alive, None], 0, top)]
        got = np.where(same.all(axis=1), width, same.argmin(axis=1))
        grown[alive] += got
        alive = alive[got == width]
        width = max(8, min(4 * width, SLAB_CELLS // max(1, len(alive))))
    return grown


def _covered(place: np.ndarray, d: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Seeds that lie in a known run whose period divides their distance (``place`` is sorted)."""
    out = np.zeros(len(place), bool)
    for start, end, q in runs:
        lo, hi = np.searchsorted(place, (start, end))
        if lo < hi:
            out[lo:hi] |= (place[lo:hi] + d[lo:hi] <= end) & (d[lo:hi] % q == 0)
    return out


def _grow(number: np.ndarray, block: int, place: np.ndarray, d: np.ndarray,
          known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Seeds -> the runs (start, end, period) that they grow to."""
    order = np.argsort(place, kind="stable")
    place, d = place[order], d[order]
    keep = ~_covered(place, d, known)
    place, d = place[keep], d[keep]
    if not len(place):
        return []
    same = np.zeros(len(place), bool)
    step = max(1, SLAB_CELLS // block)
    for k in range(0, len(place), step):
        i = place[k:k + step, None] + np.arange(block)[None, :]
        same[k:k + step] = (number[i] == number[i + d[k:k + step, None]]).all(axis=1)
    place, d = place[same], d[same]
    order = np.lexsort((place, d))
    place, d = place[order], d[order]
    if not len(place):
        return []
    head = np.ones(len(place), bool)
    head[1:] = (d[1:] != d[:-1]) | (place[1:] != place[:-1] + block)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(place)) - 1
    start, end, d = place[first], place[last] + block, d[first]
    start = start - _reach(number, start - 1, d, -1)
    end = end + _reach(number, end, d, 1) + d
    long = end - start >= np.maximum(MIN_LENGTH, 2 * d)
    return sorted(set(zip(start[long].tolist(), end[long].tolist(), d[long].tolist())))


def find_runs(number: np.ndarray, text_of: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run. ``number`` holds the words of several
    texts as numbers, a number that occurs once before, between and after them;
    ``text_of`` their texts; ``longest`` is the number of words of the longest."""
    known: list[tuple[int, int, int]] = []
    block = 2
    while 2 * block <= max(4, longest // 2):
        part = min(block, MOST_BLOCK)
        found = list(occurrences(number, part, range(0 if block == 2 else 2 * block // part, 4 * block // part)))
        place, d = (np.concatenate(x) for x in zip(*found))
        ok = (d > 0) & (place + d + part <= len(number))
        place, d = place[ok], d[ok]
        ok = text_of[place] == text_of[place + d + part - 1]
        place, d = place[ok], d[ok]
        # the first scale holds multiples of its own distances: from the smallest up
        for some in ([d == k for k in range(1, 8)] if block == 2 else [slice(None)]):
            known += _grow(number, part, place[some], d[some], known)
        block *= 2
    return known


# ---- texts -----------------------------------------------------------------------

def repeated(words: list, doc_id: int | None) -> list:
    """The words with the repetition that the contract of the query plants: in a
    tenth of the documents the words from one on repeat with some period."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _answer(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """runs: (start, length, period), sorted by start, then period."""
    listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    kept = words
    best = (None, None, None, None)
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            change[s + q] += 1
            change[s + n] -= 1
        kept = compress(words, np.cumsum(change[:-1]) == 0)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    return len(runs), *best, listed, hashlib.sha256(b" ".join(kept)).hexdigest()


def detect(texts: list[list[bytes]]) -> list[tuple]:
    """The answers of some texts, given as lists of words."""
    flat: list[bytes] = []
    for words in texts:
        flat += words
    code = pa.array(flat, pa.binary()).dictionary_encode()
    size = np.array([len(w) for w in texts], np.int64)
    first = np.cumsum(size + 1) - size  # a place is left before each text, and one after the last
    text_of = np.repeat(np.arange(len(texts)), size)
    number = np.arange(len(flat) + len(texts) + 1) + len(code.dictionary)  # the places between: numbers of their own
    at = np.arange(len(flat)) + text_of + 1
    number[at] = code.indices.to_numpy()
    owner = np.full(len(number), -1, np.int64)
    owner[at] = text_of
    mine: list[list] = [[] for _ in texts]
    for start, end, q in find_runs(number, owner, int(size.max(initial=0))):
        k = int(owner[start])
        mine[k].append((start - int(first[k]), end - start, q))
    return [_answer(w, sorted(r, key=lambda x: (x[0], x[2]))) for w, r in zip(texts, mine)]


_KIND = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
         "runs_sha256 string, collapsed_sha256 string")


def _runs_of(plant: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())
            long = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            order = np.argsort(long, kind="stable")
            out: list = [None] * len(ids)
            cut = np.searchsorted(np.cumsum(long[order]), np.arange(CHUNK_BYTES, long.sum() + CHUNK_BYTES, CHUNK_BYTES))
            for rows in np.split(order, np.unique(cut)):
                if not len(rows):
                    continue
                words = [(texts[int(r)].as_py() or b"").split() for r in rows]
                if plant:
                    words = [repeated(w, ids[int(r)]) for w, r in zip(words, rows)]
                for r, found in zip(rows, detect(words)):
                    out[int(r)] = (ids[int(r)], *found)
            names = [part.split()[0] for part in _KIND.split(", ")]
            kinds = [pa.string() if part.endswith("string") else pa.int64() for part in _KIND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)

    return run


def runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_runs, the longest run
    (ties: smallest start, then period) as start, length, period and
    exponent_milli, runs_sha256 (of all runs) and collapsed_sha256 (of the text
    without its repetitions, words joined by one space).

    ``plant`` applies ``repeated`` first, by the row's doc_id. Words are byte runs
    between ASCII white space, compared as they are. A text that is null, or
    has no word, has no runs (four nulls, and digests of nothing). A row
    without doc_id is answered with a null doc_id and nothing planted; repeated
    rows are answered each; other columns are ignored; an empty table gives an
    empty result.
    """
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_runs_of(plant), _KIND))


def _collapsed(texts: pa.Array) -> list[pa.Array]:
    out = []
    for text in texts.cast(pa.binary()).to_pylist():
        if text is None:
            out.append(None)
            continue
        words = text.split()
        number = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy()
        ends = np.array([len(words), len(words) + 1])
        found = find_runs(np.concatenate((ends[:1], number, ends[1:])),
                          np.concatenate(([-1], np.zeros(len(words), np.int64), [-1])), len(words))
        drop = np.zeros(len(words) + 1, np.int64)
        for start, end, q in found:
            drop[start - 1 + q] += 1
            drop[end - 1] -= 1
        out.append(b" ".join(compress(words, np.cumsum(drop[:-1]) == 0)).decode("utf-8", "replace"))
    return [pa.array(out, pa.string())]


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` plus collapsed_text: of every run its first period only, words
    joined by one space (null for a null text). An earlier column of that name is replaced."""
    docs = docs.drop("collapsed_text")
    return C.map_text(docs, _collapsed, "collapsed_text string").toDF(*docs.columns, "collapsed_text")
