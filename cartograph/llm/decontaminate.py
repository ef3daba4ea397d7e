"""Benchmark decontamination.

For each benchmark item the windows of its number of words slide over every
text. A window's 64-bit SimHash (of its word shingles, weighted by how often
they occur) is looked up among the items' fingerprints by eight blocks of
eight bits: fingerprints that differ in at most ``radius`` bits differ in at
most radius // 8 bits in some block, so that the union of the blocks' lookups
holds all of them. Candidates are verified by the exact weighted Jaccard
similarity of the shingles. Windows that hold no shingle of an item of their
size have similarity 0 and are not hashed at all.

A pair of similarity 0.8 differs in about 10 of 64 bits with a deviation of
about 3; the radius of 24 leaves out one in a million of them.

The benchmark goes to the tasks in parts of bounded size, one pass over the
documents for each part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import text as X

PART_BYTES = 4 << 20
BLOCKS, BLOCK_BITS = 8, 8
FILTER_BITS = 22

_WEIGHT = np.bitwise_count(np.arange(256, dtype=np.uint8))


def fingerprints(shingles: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of the runs of ``length`` shingles at ``starts``; a shingle weighs as often as it occurs."""
    bits = np.unpackbits(X.mix(shingles ^ X.const(301)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = sums[starts + length] - sums[starts]
    return np.packbits(2 * ones > length, axis=1, bitorder="little").view(np.uint64).ravel()


@dataclass
class Sized:
    """The items of one number of words."""

    words: int
    shingle: int             # words a shingle has
    items: list              # their ids
    prints: np.ndarray       # fingerprints
    sets: list               # (distinct shingles, times) of each
    near: list[np.ndarray]   # by block: [256, items], block values within radius // BLOCKS bits
    known: np.ndarray        # sorted distinct shingles of all its items


@dataclass
class Index:
    sizes: list[Sized]
    present: dict[int, np.ndarray]  # by shingle length: a bit table of all shingles
    known: dict[int, np.ndarray]    # by shingle length: all of them, sorted
    radius: int
    least: float


def _times(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(s, return_counts=True)


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard of two (distinct shingles, times): shared weight over joint weight."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / (int(a[1].sum()) + int(b[1].sum()) - shared)


def index(items: list[tuple], size: int, least: float, radius: int) -> Index:
    """items: (id, text)."""
    by_size: dict[int, list] = {}
    for name, text in items:
        if text is None:
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        h = X.words(raw, np.array([0, len(raw)])).hash
        if len(h):
            by_size.setdefault(len(h), []).append((name, X.shingles(h, size)))
    distance = _WEIGHT[np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]]
    sizes, present = [], {}
    for n, found in sorted(by_size.items()):
        prints = np.concatenate([fingerprints(s, np.array([0]), len(s)) for _, s in found])
        near = [(distance <= radius // BLOCKS)[:, (prints >> np.uint64(BLOCK_BITS * b)) & np.uint64(255)]
                for b in range(BLOCKS)]
        known = np.unique(np.concatenate([s for _, s in found]))
        k = min(size, n)
        sizes.append(Sized(n, k, [x for x, _ in found], prints, [_times(s) for _, s in found], near, known))
        table = present.setdefault(k, np.zeros(1 << FILTER_BITS, bool))
        table[known >> np.uint64(64 - FILTER_BITS)] = True
    known = {k: np.unique(np.concatenate([z.known for z in sizes if z.shingle == k])) for k in present}
    return Index(sizes, present, known, radius, least)


def _held(known: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Which of s are in the sorted ``known``."""
    return known[np.minimum(np.searchsorted(known, s), len(known) - 1)] == s


def _starts(hits: np.ndarray, reach: int, last: int) -> np.ndarray:
    """Window starts from which a hit lies within ``reach`` shingles."""
    mark = np.zeros(last + 2, np.int32)
    np.add.at(mark, np.maximum(0, hits - reach + 1), 1)
    np.add.at(mark, np.minimum(hits, last) + 1, -1)
    return np.flatnonzero(np.cumsum(mark[:-1]))


def matches(ix: Index, h: np.ndarray, hits: dict[int, np.ndarray]) -> Iterator[tuple]:
    """(item, similarity, first word, words) of the best window of each item that a text holds.
    h: its word hashes; hits: by shingle length, the places of shingles that some item may have."""
    shingled: dict[int, np.ndarray] = {}
    for z in ix.sizes:
        at = hits.get(z.shingle)
        if at is None:
            continue
        if z.shingle not in shingled:
            shingled[z.shingle] = X.shingles(h, z.shingle)
        s = shingled[z.shingle]
        at = at[_held(z.known, s[at])]
        if not len(at):
            continue
        length = min(z.words - z.shingle + 1, len(s))  # a text shorter than the item is one window
        starts = _starts(at, length, len(s) - length)
        lo, hi = starts[0], starts[-1] + length
        prints = fingerprints(s[lo:hi], starts - lo, length)
        found = np.zeros((len(starts), len(z.items)), bool)
        for b in range(BLOCKS):
            found |= z.near[b][(prints >> np.uint64(BLOCK_BITS * b)) & np.uint64(255)]
        w, i = np.nonzero(found)
        close = np.bitwise_count(prints[w] ^ z.prints[i]) <= ix.radius
        best: dict[int, tuple] = {}
        for a, k in zip(w[close], i[close]):
            start = int(starts[a])
            q = similarity(_times(s[start:start + length]), z.sets[k])
            if q >= ix.least and (k not in best or q > best[k][0]):
                best[k] = (q, start)
        for k, (q, start) in sorted(best.items()):
            yield z.items[k], q, start, length + z.shingle - 1


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = shared.value
        for batch in batches:
            rows, out = [], []
            for a, _, w in X.word_chunks(batch.column("text")):
                places: dict[int, dict[int, np.ndarray]] = {}
                for k, table in ix.present.items():
                    s = X.shingles(w.hash, k)
                    if len(w.hash) < k:
                        continue
                    at = np.flatnonzero(table[s >> np.uint64(64 - FILTER_BITS)])
                    at = at[_held(ix.known[k], s[at])]
                    row = np.searchsorted(w.first, at, "right") - 1
                    inside = at + k <= w.first[row + 1]
                    at, row = at[inside], row[inside]
                    cut = np.flatnonzero(np.diff(row)) + 1
                    for part in np.split(np.arange(len(at)), cut):
                        if len(part):
                            r = int(row[part[0]])
                            places.setdefault(r, {})[k] = at[part] - w.first[r]
                for r, hits in places.items():
                    for m in matches(ix, w.hash[w.first[r]:w.first[r + 1]], hits):
                        rows.append(a + r), out.append(m)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array([m[0] for m in out], pa.int64()),
                 pa.array([m[1] for m in out], pa.float64()), pa.array([m[2] for m in out], pa.int64()),
                 pa.array([m[3] for m in out], pa.int64())],
                ["doc_id", "item_id", "similarity", "first_word", "n_words"])

    return run


def find(docs: DataFrame, benchmark: DataFrame, size: int = 5, least: float = 0.8, radius: int = 24) -> DataFrame:
    """One row per document and benchmark item (item_id, text) that it holds:
    doc_id, item_id, similarity, and the best window (the first of equals) as
    first_word and n_words.

    Shingles have ``size`` words, fewer where an item is shorter (an item of
    fewer words is one shingle). Null texts and texts without words hold
    nothing and are held by none; a text shorter than an item is one window.
    Rows with null or repeated ids are searched each; other columns are
    ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    kind = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = bench.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    parts = max(1, -(-int(total) // PART_BYTES))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    out = None
    for p in range(parts):  # PART_BYTES of items at a time
        part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p)
        ix = index([(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()], size, least, radius)
        found = texts.mapInArrow(_search(spark.sparkContext.broadcast(ix)), kind)
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; rows without doc_id stay."""
    held = C.written(find(docs, benchmark, size, least).select("doc_id").distinct(), "contaminated")
    return docs.join(held, "doc_id", "left_anti")
