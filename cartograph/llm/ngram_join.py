"""N-gram Jaccard join by vertical partitioning.

All n-grams have one global order, from rare to frequent, and by hash among
equally frequent ones. The order is cut into fragments. Each document's set falls
apart into one segment a fragment; overlaps are counted fragment by fragment, as
rows of their own, and summed per pair.

*Classes.* Equal sets are one class, and only classes go on.

*Candidates.* Two sets that link share an n-gram in their rare ends, the first
n - ceil(n * percent / 100) + 1 of each in the global order. Classes that have
an n-gram there meet under it; a class goes on if one it meets there is of a size,
and has the n-gram at a place, that leave room for the overlap that a link needs
(at a pair's first common n-gram no earlier one can add to it). Those that go on
are tied to the smallest of them, so that a meeting gives a row a class and not a
row a pair. The rare-to-frequent order keeps common passages out of the rare ends;
an n-gram that many classes have there all the same is dealt as pairs of blocks of
its classes, so that no task meets more than two blocks. Frequencies come from a
table of 2**24 counters over all texts: a task reports the counters that stand out
from its mean. They decide about the order only, so that they cost speed at worst.

*Bounds.* A class carries a histogram of its n-grams over some n / 4 buckets of
their hashes. What two histograms have in common bounds the overlap from above.
Classes tied to one class are compared by it; the pairs that may still link make
groups, which are close to the groups of links themselves. Only classes in a group
are read again.

*Counting.* A group is cut in pairs of blocks of bounded size; a class is dealt to
its block pairs, one row a fragment. A task counts the overlaps of one block pair in
one fragment and hands on, in one row, those of pairs that can still link: a pair
that differs by more in one fragment than a link may differ in all is left out. Another
sums a block pair's fragments per pair, and returns a spanning forest of the links
and each class's number of links: as many rows as classes, never a row a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import text as X

COUNTER_BITS = 24
#: Fragments of the global order.
FRAGMENTS = 4
#: Classes and n-grams that one side of a unit of counting holds, about.
BLOCK_CLASSES = 1024
BLOCK_NGRAMS = 1_000_000
#: Classes of an n-gram in rare ends from which they meet in pairs of blocks of as many.
HOT_CLASSES = 2048
#: Classes that are compared by histograms in one task.
BOUND_CLASSES = 4096
#: Rows that a task looks for pairs in at a time, pairs at a time, and cells of histograms at a time.
MEETING_ROWS = 1 << 20
PAIRS = 1 << 21
CELLS = 1 << 22


def _signature(s: np.ndarray) -> tuple[int, int]:
    a = X.mix(s ^ X.const(101))
    return (int(a.sum(dtype=np.uint64).astype(np.int64)),
            int(X.mix(s + X.const(102)).sum(dtype=np.uint64).astype(np.int64)))


def _frequent(size: int):
    """Arrow task: the counters that stand out among a task's n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << COUNTER_BITS, np.int32)
        for batch in batches:
            for _, _, w in X.word_chunks(batch.column("text")):
                np.add.at(count, X.shingles(w.hash, size) >> np.uint64(64 - COUNTER_BITS), 1)
        mean = count.mean()
        slot = np.flatnonzero(count > mean + 4 * mean ** 0.5 + 1)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(count[slot].astype(np.int64))],
                                         ["slot", "n"])

    return run


def frequency_table(docs: DataFrame, size: int) -> np.ndarray:
    """A class of frequency (0 to 255, eighths of powers of two) for every counter."""
    found = (docs.select("text").mapInArrow(_frequent(size), "slot int, n long")
             .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())  # at most 2**COUNTER_BITS rows
    table = np.zeros(1 << COUNTER_BITS, np.uint8)
    table[found.column("slot").to_numpy()] = np.minimum(255, 8 * np.log2(found.column("n").to_numpy()))
    return table


def _rare_end(s: np.ndarray, table: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n-grams of a sorted set in the global order, as many as a partner
    must share one of, and their classes of frequency."""
    n = len(s)
    take = n - -(-n * percent // 100) + 1
    kind = table[s >> np.uint64(64 - COUNTER_BITS)]
    order = np.argsort(kind, kind="stable")[:take]
    return s[order], kind[order]


def fragment_of(s: np.ndarray, table: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of each n-gram: the last one is the frequent end of the global order, the others
    cut the rare rest, equally rare, by ranges of the hash."""
    if fragments == 1:
        return np.zeros(len(s), np.int64)
    part = (((s >> np.uint64(32)) * np.uint64(fragments - 1)) >> np.uint64(32)).astype(np.int64)
    return np.where(table[s >> np.uint64(64 - COUNTER_BITS)] > 0, fragments - 1, part)


def histogram(s: np.ndarray) -> np.ndarray:
    """How many n-grams fall into each of a power of two of buckets, four to eight on average (so that
    a byte holds them)."""
    size = 16
    while size * 8 < len(s):
        size *= 2
    at = (X.mix(s ^ X.const(103)) & np.uint64(size - 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=size), 255).astype(np.uint8)


def file_sets(size: int, percent: int, shared, hot_classes: int):
    """Arrow task: (doc_id, text) -> (doc_id, n, s1, s2, keys, cool, buckets): the rare end in the global
    order, the first ``cool`` of it too rare to be hot, and the histogram. Of a task's equal sets the
    first of a row with doc_id has them; rows without meet nobody."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hot = shared.value, min(255, int(8 * np.log2(hot_classes)))
        for batch in batches:
            n, s1, s2, cool, buckets = [], [], [], [], []
            keys, seen = [np.zeros(0, np.uint64)], set()
            counts = []
            has_id = batch.column("doc_id").is_valid().to_pylist()
            for a, b, w in X.word_chunks(batch.column("text")):
                for r in range(b - a):
                    s = np.unique(X.shingles(w.hash[w.first[r]:w.first[r + 1]], size))
                    x, y = _signature(s) if len(s) else (0, 0)
                    fresh = len(s) and has_id[a + r] and (x, y) not in seen
                    own, kind = _rare_end(s, table, percent) if fresh else (s[:0], s[:0])
                    if fresh:
                        seen.add((x, y))
                    n.append(len(s)), s1.append(x), s2.append(y)
                    keys.append(own), counts.append(len(own)), cool.append(int((kind < hot).sum()))
                    buckets.append(histogram(s).tobytes() if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()),
                 X.list_column(np.concatenate(keys).astype(np.int64), np.array(counts, np.int64), pa.int64()),
                 pa.array(cool, pa.int32()), pa.array(buckets, pa.binary())],
                ["doc_id", "n", "s1", "s2", "keys", "cool", "buckets"])

    return run


# ---- candidates ------------------------------------------------------------------

def going_on(place: np.ndarray, side: np.ndarray, n: np.ndarray, at: np.ndarray, s1: np.ndarray, percent: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """(class, class that it is tied to) of those that meet one they may link with; rows sorted by
    (place, n). ``side`` is 0, or the side of a block pair: only classes of different sides meet.
    ``at`` is the place of the common n-gram in the class's order."""
    if not len(place):
        return s1, s1
    fresh = np.concatenate(([True], place[1:] != place[:-1]))
    group = np.cumsum(fresh) - 1
    top = np.searchsorted((group << 40) | n, (group << 40) | (n * 100 // percent), "right")
    many = np.maximum(0, top - np.arange(len(n)) - 1)
    total = np.cumsum(many)
    on = np.zeros(len(n), bool)
    for some in np.split(np.arange(len(n)), np.unique(np.searchsorted(total, np.arange(PAIRS, int(total[-1]) + PAIRS, PAIRS)))):
        size = many[some]
        if not size.sum():
            continue
        i = np.repeat(some, size)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size)
        room = np.minimum(n[i] - at[i], n[j] - at[j])
        ok = (room * (100 + percent) >= percent * (n[i] + n[j])) & (s1[i] != s1[j]) & ((side[i] == 0) | (side[i] != side[j]))
        on[i[ok]] = on[j[ok]] = True
    hub = np.minimum.reduceat(np.where(on, s1, np.iinfo(np.int64).max), np.flatnonzero(fresh))[group]
    both = np.unique(np.stack([s1[on], hub[on]]), axis=1)
    return both[0], both[1]


def _meet(percent: int):
    """Arrow task: rows sorted by (place, n) -> (s1, hub)."""
    names = ("place", "side", "n", "at", "s1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out(rows: list) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in going_on(*rows, percent)], ["s1", "hub"])

        for batch in batches:
            held.append([batch.column(c).to_numpy().astype(np.int64) for c in names])
            size += batch.num_rows
            if size >= MEETING_ROWS:
                rows = [np.concatenate(x) for x in zip(*held)]
                last = np.flatnonzero(rows[0][1:] != rows[0][:-1])  # the last place may go on
                cut = int(last[-1]) + 1 if len(last) else 0
                yield from out([x[:cut] for x in rows])
                held, size = [[x[cut:] for x in rows]], len(rows[0]) - cut
        if held:
            yield from out([np.concatenate(x) for x in zip(*held)])

    return run


def candidates(filed: DataFrame, percent: int, hot_classes: int) -> DataFrame:
    """(s1, hub): classes that may link are tied to a common class; that class to itself."""
    zero = F.lit(0).cast("long")
    ends = (filed.where("doc_id is not null and n > 0").select("s1", "n", "cool", F.posexplode("keys").alias("at", "key"))
            .withColumn("hot", F.col("at") >= F.col("cool")))
    cool = ends.where("not hot").select(F.col("key").alias("place"), zero.alias("side"), "n", "at", "s1")
    # hot ones: first counted (a row a task and n-gram), then dealt to pairs of blocks
    hot = ends.where("hot").select("key", "n", "at", "s1")
    blocks = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / hot_classes).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("s1"), F.col("blocks")).cast("int")
    dealt = (hot.join(blocks, "key").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("place"),
                     F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
                     .cast("long").alias("side"), "n", "at", "s1"))
    # a block meets itself in the place of its own pair only
    return (cool.unionByName(dealt).repartition(F.col("place")).sortWithinPartitions("place", "n")
            .mapInArrow(_meet(percent), "s1 long, hub long").distinct())


# ---- bounds ----------------------------------------------------------------------

class Forest:
    """Merged groups of numbered things; each group's root is its smallest."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, x: np.ndarray) -> np.ndarray:
        out = self.parent[x]
        while (self.parent[out] != out).any():
            out = self.parent[out]
        self.parent[x] = out
        return out

    def merge(self, i: int, others: np.ndarray) -> None:
        r = np.unique(self.roots(np.append(others, i)))
        self.parent[r] = r[0]


def within_bound(n: np.ndarray, buckets: list[np.ndarray], side: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each class those after it, by size, that the histograms let link with it. Classes sorted by n."""
    width = np.array(list(map(len, buckets)), np.int64)
    for size in np.unique(width):
        # a partner is at most a hundred over percent times as large: its buckets are folded to this size
        least, most = int(n[width == size].min()), int(n[width == size].max()) * 100 // percent
        near = np.flatnonzero((width >= size) & (n >= least) & (n <= most))
        table = np.stack([buckets[k].astype(np.uint16).reshape(-1, size).sum(axis=0, dtype=np.uint16) for k in near])
        spot = np.full(len(n), -1, np.int64)
        spot[near] = np.arange(len(near))
        step = max(1, CELLS // int(size))
        for i in np.flatnonzero(width == size):
            top = int(np.searchsorted(n, n[i] * 100 // percent, "right"))
            found = []
            js = near[(near > i) & (near < top)]
            if side[i]:
                js = js[side[js] != side[i]]
            for k in range(0, len(js), step):
                some = js[k:k + step]
                most_shared = np.minimum(table[spot[some]], table[spot[i]]).sum(axis=1, dtype=np.int64)
                found.append(some[(100 + percent) * most_shared >= percent * (n[i] + n[some])])
            if found:
                yield i, np.concatenate(found)


def _groups(percent: int):
    """Arrow task: classes sorted by place -> (s1, root): spanning forests of the pairs within bound."""

    def group(rows: list) -> pa.RecordBatch:
        side, n, s1 = (np.concatenate([r[c] for r in rows]).astype(np.int64) for c in range(3))
        buckets = [b for r in rows for b in r[3]]
        order = np.lexsort((s1, n))
        side, n, s1 = side[order], n[order], s1[order]
        forest = Forest(len(n))
        for i, js in within_bound(n, [np.frombuffer(buckets[k], np.uint8) for k in order], side, percent):
            if len(js):
                forest.merge(i, js)
        root = forest.roots(np.arange(len(n)))
        tied = np.flatnonzero(root != np.arange(len(n)))
        return pa.RecordBatch.from_arrays([pa.array(s1[tied]), pa.array(s1[root[tied]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in C.grouped(batches, ("place",), ("side", "n", "s1"), "buckets", lambda x: x.to_pylist()):
            yield group(rows)

    return run


def likely_groups(filed: DataFrame, ties: DataFrame, percent: int, scratch: C.Scratch) -> DataFrame:
    """(s1, comp): the classes that the histograms let link with another one, and their group."""
    seen = (filed.where("buckets is not null").select("s1", "n", "buckets")
            .groupBy("s1").agg(F.any_value("n").alias("n"), F.any_value("buckets").alias("buckets")))
    many = ties.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BOUND_CLASSES).cast("int").alias("blocks")).where("blocks > 1")
    own = F.pmod(F.xxhash64("s1"), F.col("blocks")).cast("int")
    dealt = (ties.join(many, "hub", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("s1", F.xxhash64("hub", F.least("own", "other"), F.greatest("own", "other")).alias("place"),
                     F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
                     .cast("long").alias("side")))
    edges = (dealt.join(seen, "s1").repartition(F.col("place")).sortWithinPartitions("place")
             .select("place", "side", "n", "s1", "buckets").mapInArrow(_groups(percent), "u long, v long"))
    groups = C.components(edges, scratch, "likely")
    return (groups.union(groups.select(F.col("v").alias("u"), "v").distinct())
            .select(F.col("u").alias("s1"), F.col("v").alias("comp")))


# ---- counting --------------------------------------------------------------------

def read_segments(size: int, shared, fragments: int):
    """Arrow task: classes with a text and their block pairs -> a row for each block pair and fragment:
    the segment's sorted n-gram hashes, none too. A row whose text is not the one that was filed (a
    repeated id) is left out."""
    names = ["comp", "lo", "hi", "fragment", "own", "n", "s1", "s2", "rep", "copies", "grams"]
    small = ("lo", "hi", "fragment", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            about = list(zip(*(batch.column(c).to_pylist() for c in ("s1", "s2", "comp", "own", "parts", "rep", "copies"))))
            out: list[tuple] = []
            grams: list[np.ndarray] = []
            held = 0

            def flush() -> pa.RecordBatch:
                cols = [pa.array([r[k] for r in out], pa.int32() if names[k] in small else pa.int64())
                        for k in range(len(names) - 1)]
                flat = np.concatenate(grams).astype(np.int64)
                return pa.RecordBatch.from_arrays(
                    [*cols, X.list_column(flat, np.array(list(map(len, grams)), np.int64), pa.int64())], names)

            for a, b, w in X.word_chunks(batch.column("text")):
                for r in range(b - a):
                    s = np.unique(X.shingles(w.hash[w.first[r]:w.first[r + 1]], size))
                    s1, s2, comp, own, parts, rep, copies = about[a + r]
                    if not len(s) or _signature(s) != (s1, s2):
                        continue
                    part = fragment_of(s, table, fragments)
                    for f in range(fragments):
                        mine = s[part == f]
                        for other in range(parts):
                            out.append((comp, min(own, other), max(own, other), f, own, len(s), s1, s2, rep, copies))
                            grams.append(mine)
                            held += len(mine)
                    if held > BLOCK_NGRAMS:
                        yield flush()
                        out, grams, held = [], [], 0
            if out:
                yield flush()

    return run


def count_segments(sets: list[np.ndarray], n: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
                   ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each set of ``left``: the sets of ``right`` whose segments leave a link possible, and
    how many n-grams they share. ``n``: sizes of the whole sets."""
    gram = np.concatenate([sets[j] for j in right])
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(right)), size[right])
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    for i in left:
        lo, hi = np.searchsorted(gram, sets[i], "left"), np.searchsorted(gram, sets[i], "right")
        reach = hi - lo
        got = int(reach.sum())
        if not got:
            continue
        at = np.repeat(lo - (np.cumsum(reach) - reach), reach) + np.arange(got)
        shared = np.bincount(owner[at], minlength=len(right))
        both = n[i] + n[right]
        may_differ = both - 2 * -(-percent * both // (100 + percent))
        j = np.flatnonzero((shared > 0) & (size[i] + size[right] - 2 * shared <= may_differ))
        if len(j):
            yield i, j, shared[j]


_KEY = ("comp", "lo", "hi", "fragment")
_WHO = ("own", "n", "s1", "s2", "rep", "copies")
_COUNTED = ("comp long, lo int, hi int, fragment int, n array<long>, s1 array<long>, s2 array<long>, rep array<long>, "
            "copies array<long>, left array<int>, right array<int>, shared array<int>")


def _count(percent: int):
    """Arrow task: segments sorted by (comp, lo, hi, fragment) -> one row for each of these: the pairs
    of its classes, by their rank, and the n-grams they share in the fragment. Fragment 0 has the classes."""
    names = [part.split()[0] for part in _COUNTED.split(", ")]

    def group(k: tuple, rows: list) -> pa.RecordBatch:
        own, n, s1, s2, rep, copies = (np.concatenate([r[c] for r in rows]).astype(np.int64) for c in range(6))
        # by rank, the same in all fragments; rows that repeat a document bring its class again
        _, once = np.unique(np.stack([s1, s2]), axis=1, return_index=True)
        own, n, s1, s2, rep, copies = (x[once] for x in (own, n, s1, s2, rep, copies))
        sets = [g for r in rows for g in r[6]]
        sets = [sets[j].astype(np.uint64) for j in once]
        left, right = np.flatnonzero(own == k[1]), np.flatnonzero(own == k[2])
        found = [np.zeros((3, 0), np.int64)]
        if len(left) and len(right):
            for i, j, o in count_segments(sets, n, left, right, percent):
                j = right[j]
                if k[1] == k[2]:  # each pair once
                    o, j = o[j > i], j[j > i]
                found.append(np.stack([np.full(len(j), i), j, o]))
        pairs = np.concatenate(found, axis=1)
        who = [n, s1, s2, rep, copies] if k[3] == 0 else [n[:0]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0]], pa.int64()), *(pa.array([x], pa.int32()) for x in k[1:]),
             *(pa.array([x], pa.list_(pa.int64())) for x in who), *(pa.array([x], pa.list_(pa.int32())) for x in pairs)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in C.grouped(batches, _KEY, _WHO, "grams", C.list_values):
            yield group(k, rows)

    return run


def _sum(percent: int):
    """Arrow task: the rows of ``_count`` sorted by (comp, lo, hi, fragment) -> (s1, s2, u, v, links): of each class
    with links in the block pair its document and that of its root, and how many documents it links with."""

    def group(rows: list) -> pa.RecordBatch | None:
        n, s1, s2, rep, copies = (np.concatenate([r[c][0] for r in rows]).astype(np.int64) for c in range(5))
        i, j, o = (np.concatenate([r[c][0] for r in rows]).astype(np.int64) for c in (5, 6, 7))
        if not len(i):
            return None
        code, back = np.unique(i * len(n) + j, return_inverse=True)
        shared = np.bincount(back, weights=o).astype(np.int64)
        i, j = code // len(n), code % len(n)
        link = (100 + percent) * shared >= percent * (n[i] + n[j])
        i, j = i[link], j[link]
        if not len(i):
            return None
        links = np.bincount(i, copies[j], len(n)) + np.bincount(j, copies[i], len(n))
        forest = Forest(len(n))
        cut = np.flatnonzero(np.diff(i)) + 1
        for a, b in zip(np.concatenate(([0], cut)), np.append(cut, len(i))):
            forest.merge(int(i[a]), j[a:b])
        on = np.flatnonzero(links)
        cols = [s1[on], s2[on], rep[on], rep[forest.roots(on)], links[on].astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["s1", "s2", "u", "v", "links"])

    lists = ("n", "s1", "s2", "rep", "copies", "left", "right", "shared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in _KEY[:3])))
            cols = [C.list_values(batch.column(c)) for c in lists]
            for r, k in enumerate(keys):
                if k != now and held:
                    out = group(held)
                    if out is not None:
                        yield out
                    held = []
                now = k
                held.append([[c[r]] for c in cols])
        if held and (out := group(held)) is not None:
            yield out

    return run


def links(docs: DataFrame, classes: DataFrame, groups: DataFrame, size: int, percent: int, table) -> DataFrame:
    """(s1, s2, u, v, links) of the classes that link with another one; see ``_sum``."""
    members = classes.join(groups, "s1")
    parts = (members.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_NGRAMS))
                                         .cast("int").alias("parts")))
    wanted = (members.join(parts, "comp").withColumn("own", F.pmod(F.xxhash64("s1", "s2"), F.col("parts")).cast("int"))
              .select("s1", "s2", "comp", "own", "parts", "rep", "copies"))
    segments = (docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("rep")).drop("doc_id")
                .mapInArrow(read_segments(size, table, FRAGMENTS),
                            "comp long, lo int, hi int, fragment int, own int, n long, s1 long, s2 long, rep long, copies long, "
                            "grams array<long>"))
    counted = segments.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(_count(percent), _COUNTED)
    return (counted.repartition(*_KEY[:3]).sortWithinPartitions(*_KEY)
            .mapInArrow(_sum(percent), "s1 long, s2 long, u long, v long, links long"))


def join(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, n_shingles,
    component_id (smallest doc_id reachable by links, itself included) and
    n_links (documents linked with it, equal ones included).

    A text that is null or has no word has the empty set, links with nothing
    and is its own component. A row without doc_id is returned with its
    n_shingles, a null component and no links. Rows that repeat a doc_id count
    as one node with the links of all its texts; a document that links with
    several of them counts for each in n_links. An empty table gives an empty result; other columns are
    ignored.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must lie in 1..100")
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "ngram-join")
    table = spark.sparkContext.broadcast(frequency_table(docs, size))  # 2**COUNTER_BITS bytes
    filed = scratch.written(docs.select("doc_id", "text").mapInArrow(
        file_sets(size, percent, table, HOT_CLASSES),
        "doc_id long, n long, s1 long, s2 long, keys array<long>, cool int, buckets binary"), "sets")
    ties = scratch.written(candidates(filed, percent, HOT_CLASSES), "ties")
    C.release(spark)
    groups = likely_groups(filed, ties, percent, scratch)
    nodes = filed.where("n > 0 and doc_id is not null").select("doc_id", "s1", "s2", "n").distinct()
    classes = scratch.written(nodes.groupBy("s1", "s2", "n")
                              .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    found = scratch.written(links(docs, classes, groups, size, percent, table), "links")
    C.release(spark)
    degree = found.groupBy("s1", "s2").agg(F.sum("links").alias("other_links"))
    repeated = filed.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("s1").alias("a"), F.max("s1").alias("b"), F.min("s2").alias("c"), F.max("s2").alias("d"))
    several = scratch.written(filed.where("doc_id is not null").select("doc_id", "s1", "s2", "n").distinct()
                              .join(repeated.where("a <> b or c <> d").select("doc_id"), "doc_id"), "repeated")
    same = several.join(classes, ["s1", "s2", "n"]).select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    linked = C.components(found.select("u", "v").union(same), scratch)
    about = (classes.join(degree, ["s1", "s2"], "left")
             .join(linked.select(F.col("u").alias("rep"), F.col("v").alias("root")), "rep", "left")
             .select("s1", "s2", "n", F.coalesce("root", "rep").alias("root"),
                     (F.coalesce("other_links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    whole = (several.join(about, ["s1", "s2", "n"], "left").groupBy("doc_id")
             .agg(F.min("root").alias("of_all"), F.sum("links").alias("links_of_all")))
    return scratch.last(
        filed.select("doc_id", "n", "s1", "s2").join(about, ["s1", "s2", "n"], "left").join(whole, "doc_id", "left")
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.when(F.col("doc_id").isNotNull(), F.coalesce("of_all", "root", "doc_id")).alias("component_id"),
                F.when(F.col("doc_id").isNull(), F.lit(0))
                .otherwise(F.coalesce("links_of_all", "links", F.lit(0))).cast("long").alias("n_links")))


def one_per_group(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` but for those whose doc_id is not the smallest of its
    component. Rows without doc_id stay."""
    others = join(docs, size, percent).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti")
