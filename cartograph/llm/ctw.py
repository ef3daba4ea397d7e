"""Language-model scoring by context-tree weighting.

A text is its UTF-8 bytes and one closing byte 0xFF (which UTF-8 never has);
0xFF also stands before its start. A byte is eight binary decisions, each in a
context of the decisions before it in the byte and of the last 0 to 5 bytes.
A node (depth, context, decisions so far) holds the training counts of both
outcomes; its Krichevsky-Trofimov estimate is mixed with its children's by the
weights of context-tree weighting, computed in the logarithm from the leaves
up. The trained tree is frozen: a text's score does not depend on other texts
that are scored. Where training never saw a deeper context, the mixture ends
at the deepest one that it saw.

Nothing of the tree is hashed or of fixed size. The grams (a byte and the five
before it) of all texts are counted once. Those with the same three nearest
bytes, at most 2**24, meet in a task, which builds the nodes of depths 5 to 3;
Spark SQL sums them up to depths 2 to 0, which have at most 2**24 + 2**16 + 2**8
nodes: the broadcast's proven bound. A second pass goes down the tree and gives
every distinct gram its log10 probability. A text's score is the sum over its
grams: those of the ``hot_grams`` most frequent ones come with the broadcast,
all others are joined by gram.

The unigram base needs the count of every word. The ``hot_words`` most
frequent ones go with the broadcast, all others are joined by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import text as X

DEPTH = 5
END = 0xFF
SHARED = 3         # grams meet by so many nearest bytes; the nodes of fewer are broadcast
CACHE_BITS = 22    # slots that hold the hot grams
BLOCK = 400_000    # grams that a task works on at a time, and then to the end of their group
FLUSH = 2_000_000  # distinct keys a task holds before it hands partial counts on
FRESH = 500_000    # keys beside the merged ones before they are merged
ROWS_OUT = 100_000 # rows of a batch that a task hands on


# ---- bytes in context -------------------------------------------------------

def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every position: its byte and, above it, the DEPTH bytes before
    (nearest lowest). -> (grams, first position of each row, one past its closing byte)."""
    n = np.diff(offsets)
    rows = len(n)
    buf = np.full(DEPTH + int(offsets[-1]) + DEPTH * rows, END, np.uint8)
    first = DEPTH + offsets[:-1] + DEPTH * np.arange(rows)
    for r in range(rows):
        buf[first[r]:first[r] + n[r]] = data[offsets[r]:offsets[r + 1]]
    g = buf[DEPTH:].astype(np.uint64)
    for j in range(1, DEPTH + 1):
        g |= buf[DEPTH - j:len(buf) - j].astype(np.uint64) << np.uint64(8 * j)
    return g, first - DEPTH, first - DEPTH + n + 1


class Tally:
    """Counts by key, merged as they come."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = self.merged = 0

    def add(self, keys: np.ndarray) -> None:
        if not len(keys):
            return
        u, c = np.unique(keys, return_counts=True)
        self.keys.append(u), self.counts.append(c)
        self.held += len(u)
        if self.held - self.merged > FRESH:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        k, c = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(k, kind="stable")
        k, c = k[order], c[order]
        at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        self.keys, self.counts = [k[at]], [np.add.reduceat(c, at)]
        self.held = self.merged = len(at)
        return self.keys[0], self.counts[0]


GRAM, WORD, ROWS = 0, 1, 2
COUNTS = "kind int, key long, n long, m long"


def _rows_of(g: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which grams are of a text, and the row of each such gram."""
    step = np.zeros(len(g) + 1, np.int8)
    step[first] += 1
    step[last] -= 1
    return np.cumsum(step[:-1]).astype(bool), np.repeat(np.arange(len(first)), last - first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task: byte grams of all texts (n) and of those to learn
    from (m), and the latter's words and rows."""
    _scorers.clear()    # a worker may still hold an earlier run's
    learnt, other, words = Tally(), Tally(), Tally()
    rows = 0

    def out(t: Tally, kind: int, learn: bool) -> Iterator[pa.RecordBatch]:
        keys, counts = t.merge()
        t.__init__()
        for a in range(0, len(keys), ROWS_OUT):
            k, c = keys[a:a + ROWS_OUT].astype(np.int64), counts[a:a + ROWS_OUT].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k),
                                              pa.array(c), pa.array(c if learn else 0 * c)], ["kind", "key", "n", "m"])

    parts = ((learnt, GRAM, True), (other, GRAM, False), (words, WORD, True))
    for batch in batches:
        learn = batch.column("learn").to_numpy(zero_copy_only=False)
        rows += int(learn.sum())
        for a, b, w in X.word_chunks(batch.column("text")):
            g, first, last = grams(w.data, w.offsets)
            coded, row = _rows_of(g, first, last)
            g, mine = g[coded], learn[a:b]
            learnt.add(g[mine[row]])
            other.add(g[~mine[row]])
            words.add(w.hash[np.repeat(mine, np.diff(w.first))])
            for t, kind, of in parts:
                if len(t.keys) == 1 and t.held > FLUSH:
                    yield from out(t, kind, of)
    for part in parts:
        yield from out(*part)
    yield pa.RecordBatch.from_arrays([pa.array([ROWS], pa.int32()), pa.array([0], pa.int64()),
                                      pa.array([rows], pa.int64()), pa.array([rows], pa.int64())], ["kind", "key", "n", "m"])


# ---- weights of the tree, from the leaves up ----------------------------------

def _lgamma(x, log=F.log):
    """ln of the gamma function for x >= 0.5: Stirling's series at x + 7."""
    z = x + 7
    low = x
    for k in range(1, 7):
        low = low * (x + k)
    y = 1 / (z * z)
    return ((z - 0.5) * log(z) - z + 0.9189385332046727
            + (1 / z) * (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680))) - log(low))


def _estimate() -> Column:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    a, b = F.col("n0").cast("double"), F.col("n1").cast("double")
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1) - F.lit(1.1447298858494002)


_SMALL = 1 << 14
_HALF = np.concatenate(([0.0], np.cumsum(np.log(np.arange(_SMALL - 1) + 0.5))))    # ln gamma(k + 1/2) - ln gamma(1/2)
_WHOLE = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1.0, _SMALL)))))        # ln gamma(k + 1)


def _kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """As ``_estimate``, of arrays."""
    n = n0 + n1
    small = n < _SMALL
    a, b = (np.where(small, x, 0).astype(np.int64) for x in (n0, n1))
    out = _HALF[a] + _HALF[b] - _WHOLE[a + b]
    if not small.all():
        a, b = n0[~small], n1[~small]
        out[~small] = (_lgamma(a + 0.5, np.log) + _lgamma(b + 0.5, np.log) - _lgamma(a + b + 1, np.log)
                       - 1.1447298858494002)
    return out


class Level:
    """The distinct (context of one depth, byte) of some grams, in order. ``back``
    is the row of each gram given; ``node[j]`` is the node of each row that takes
    the byte's decision j, ``first[j]`` the first row of each node, ``n0[j]`` and
    ``n1[j]`` the nodes' training counts."""

    def __init__(self, ctx: np.ndarray, byte: np.ndarray, m: np.ndarray):
        key = (ctx << np.uint64(8)) | byte
        order = np.argsort(key, kind="stable")
        k = key[order]
        fresh = np.concatenate(([True], k[1:] != k[:-1]))
        at = np.flatnonzero(fresh)
        self.back = np.empty(len(key), np.int64)
        self.back[order] = np.cumsum(fresh) - 1
        self.key = k[at]
        self.ctx, self.byte = self.key >> np.uint64(8), self.key & np.uint64(255)
        self.m = np.add.reduceat(m[order], at)
        self.bit, self.node, self.first, self.n0, self.n1 = [], [], [], [], []

    def count(self) -> "Level":
        for j in range(8):
            p = self.key >> np.uint64(8 - j)
            fresh = np.concatenate(([True], p[1:] != p[:-1]))
            bit = ((self.byte >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
            node, first = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
            self.node.append(node), self.first.append(first), self.bit.append(bit)
            self.n0.append(np.add.reduceat(np.where(bit, 0, self.m), first).astype(float))
            self.n1.append(np.add.reduceat(np.where(bit, self.m, 0), first).astype(float))
        return self

    def above(self, depth: int) -> "Level":
        """The level of the ``depth`` nearest bytes of the contexts."""
        return Level(self.ctx & np.uint64((1 << 8 * depth) - 1), self.byte, self.m)


def _levels(gram: np.ndarray, m: np.ndarray) -> list[Level]:
    """The levels of depths DEPTH to SHARED of grams that hold all that share SHARED bytes."""
    g = gram.astype(np.uint64)
    out = [Level(g >> np.uint64(8), g & np.uint64(255), m).count()]
    for depth in range(DEPTH - 1, SHARED - 1, -1):
        out.append(out[-1].above(depth).count())
    return out


def _weigh(levels: list[Level], j: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Of decision j: the odds of each level's nodes, and the last level's weighted ln probabilities."""
    weighted = _kt(levels[0].n0[j], levels[0].n1[j])
    odds = [np.zeros(len(weighted))]
    for low, high in zip(levels, levels[1:]):
        above = high.node[j][high.back[low.first[j]]]
        below = np.bincount(above, weights=weighted, minlength=len(high.first[j]))
        own = _kt(high.n0[j], high.n1[j])
        odds.append(own - below)
        weighted = np.maximum(own, below) + np.log1p(np.exp(-np.abs(odds[-1]))) - 0.6931471805599453
    return odds, weighted


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """(gram, n, m) of rows that are sorted by their SHARED nearest bytes, in
    blocks that end where those change."""
    held, size, due = [], 0, BLOCK
    for batch in batches:
        held.append([batch.column(c).to_numpy() for c in ("gram", "n", "m")])
        size += batch.num_rows
        if size < due:
            continue
        cols = [np.concatenate(x) for x in zip(*held)]
        near = (cols[0] >> 8) & ((1 << 8 * SHARED) - 1)
        change = np.flatnonzero(near[1:] != near[:-1])
        if len(change):
            cut = int(change[-1]) + 1
            yield [c[:cut] for c in cols]
            cols = [c[cut:].copy() for c in cols]
        held, size = [cols], len(cols[0])
        due = max(BLOCK, 2 * size)
    if size:
        yield [np.concatenate(x) for x in zip(*held)]


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of depth SHARED that training has."""
    for gram, _, m in _blocks(batches):
        gram, m = gram[m > 0], m[m > 0]
        if not len(gram):
            continue
        levels = _levels(gram, m)
        top = levels[-1]
        for j in range(8):
            _, weighted = _weigh(levels, j)
            at = top.first[j]
            prefix = (1 << j) + (top.byte[at].astype(np.int32) >> (8 - j))
            yield pa.RecordBatch.from_arrays(
                [pa.array(top.ctx[at].astype(np.int64)), pa.array(prefix, pa.int32()), pa.array(top.n0[j].astype(np.int64)),
                 pa.array(top.n1[j].astype(np.int64)), pa.array(weighted)], ["ctx", "prefix", "n0", "n1", "weighted"])


@dataclass
class Top:
    """The nodes of fewer than SHARED bytes, by (depth, context, decisions) in order."""

    key: np.ndarray
    one: np.ndarray      # probability of a one
    share: np.ndarray    # of a node's own estimate against its children's

    def of(self, depth: int, level: Level, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row of a level: whether its node exists, the probability of the row's decision, the share."""
        prefix = np.uint64(1 << j) + (level.byte >> np.uint64(8 - j))
        key = (np.uint64(depth << 24) | (level.ctx << np.uint64(8)) | prefix).astype(np.int64)
        if not len(self.key):
            return np.zeros(len(key), bool), np.zeros(len(key)), np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        one = self.one[at]
        return self.key[at] == key, np.where((level.byte >> np.uint64(7 - j)) & np.uint64(1), one, 1 - one), self.share[at]


def _down(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(gram, n, lp): log10 of the probability of each gram's byte after its context."""
        for gram, n, m in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n), pa.array(log10_of(shared.value, gram, m))],
                                             ["gram", "n", "lp"])

    return run


def log10_of(top: Top, gram: np.ndarray, m: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's byte after its context, from the
    training counts of all grams that share SHARED bytes with one of them."""
    deep = _levels(gram, m)
    high = [deep[-1]]
    for depth in range(SHARED - 1, -1, -1):
        high.append(high[-1].above(depth))
    levels = deep[:-1] + high      # depth DEPTH first
    out = np.zeros(len(levels[0].key))
    for j in range(8):
        odds, _ = _weigh(deep, j)
        p = rest = known = own = share = None
        for depth, level in enumerate(reversed(levels)):
            if depth < SHARED:
                there, mine, part = top.of(depth, level, j)
            else:
                i, node = DEPTH - depth, level.node[j]
                n = (level.n0[j] + level.n1[j])[node]
                there = n > 0
                mine = (np.where(level.bit[j], level.n1[j][node], level.n0[j][node]) + 0.5) / (n + 1)
                part = (1 / (1 + np.exp(-np.clip(odds[i], -700, 700))))[node]
            if p is None:
                p, rest, known = np.where(there, 0.0, 0.5), np.ones(len(there)), there
            else:  # the node above is known to be the deepest, or hands on a share
                up = levels[DEPTH - depth + 1].back
                p, rest, known, own, share = (x[up] for x in (p, rest, known, own, share))
                there = known & there
                w = np.where(there, share, 1.0)
                p = p + np.where(known, rest * w * own, 0)
                rest = np.where(known, rest * (1 - w), rest)
                known = there
            own, share = mine, part
        out += np.log10(np.maximum(p + np.where(known, rest * own, 0), 1e-300))
    return out[levels[0].back]


def _near(grams_of: DataFrame) -> DataFrame:
    """Grams dealt and sorted by their SHARED nearest bytes: at most 2**24 distinct ones have the same."""
    near = F.shiftright("gram", 8).bitwiseAND((1 << 8 * SHARED) - 1)
    return grams_of.select("gram", "n", "m", near.alias("near")).repartition("near").sortWithinPartitions("near").drop("near")


def values(counts: DataFrame, scratch: C.Scratch) -> DataFrame:
    """(gram, n, m), every gram once, m its count in training -> (gram, n, lp): lp is
    log10 of the trained tree's probability of the gram's byte after its context."""
    level = scratch.written(_near(counts).mapInArrow(_up, "ctx long, prefix int, n0 long, n1 long, weighted double"),
                            f"depth-{SHARED}")
    levels = []
    for depth in range(SHARED - 1, -1, -1):
        low = (level.groupBy(F.col("ctx").bitwiseAND((1 << 8 * depth) - 1).alias("ctx"), "prefix")
               .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("below"))
               .withColumn("own", _estimate()).withColumn("odds", F.col("own") - F.col("below"))
               .withColumn("weighted", F.greatest("own", "below") + F.log1p(F.exp(-F.abs(F.col("odds"))))
                           - F.lit(0.6931471805599453))
               .select("ctx", "prefix", "n0", "n1", "weighted", "odds"))
        level = scratch.written(low, f"depth-{depth}")
        levels.append(level.select((F.lit(depth << 24) + F.shiftleft("ctx", 8) + F.col("prefix")).alias("key"),
                                   ((F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)).alias("one"),
                                   (1 / (1 + F.exp(-F.col("odds")))).alias("share")))
    nodes = reduce(DataFrame.union, levels).toArrow()   # at most 2**24 + 2**16 + 2**8 rows
    key = nodes.column("key").to_numpy()
    order = np.argsort(key)
    top = Top(key[order], *(nodes.column(c).to_numpy()[order] for c in ("one", "share")))
    shared = counts.sparkSession.sparkContext.broadcast(top)
    return scratch.written(_near(counts).mapInArrow(_down(shared), "gram long, n long, lp double"), "values")


@dataclass
class Model:
    """What goes with the broadcast for scoring: at most ``hot_grams`` and ``hot_words`` entries."""

    gram: np.ndarray          # the most frequent grams, rarest first
    lp: np.ndarray            # log10 probability of each
    hot: np.ndarray           # hashes of the most frequent words, sorted
    hot_log: np.ndarray       # log10(count + 1) of each
    rows: int = 0             # training texts
    tokens: int = 0           # training tokens
    distinct: int = 0         # distinct training tokens


def _frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows of the highest ``n``, at most ``most`` of them: whole classes of an eighth of an octave, no sort."""
    kind = F.floor(F.log2("n") * 8)
    seen, least = 0, None
    for k, c in table.groupBy(kind.alias("k")).count().orderBy(F.desc("k")).collect():   # at most 8 * 63 rows
        seen += c
        if seen > most:
            break
        least = k
    return table.where(F.lit(False) if least is None else kind >= least)


def train(docs: DataFrame, train_on: Column, scratch: C.Scratch, hot_words: int = 1 << 19,
          hot_grams: int = 1 << 21) -> tuple[Model, DataFrame, DataFrame]:
    """-> (model, (word, n) of all training words, (gram, n, lp) of all texts' grams)."""
    counts = scratch.written(docs.select("text", F.coalesce(train_on, F.lit(False)).alias("learn"))
                             .mapInArrow(_count, COUNTS).groupBy("kind", "key")
                             .agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "counts")
    total = {r["kind"]: (r["n"], r["k"]) for r in counts.where(F.col("kind") != GRAM)
             .groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()}
    rows = (total.get(ROWS) or (0, 0))[0]
    words = counts.where(F.col("kind") == WORD).select(F.col("key").alias("word"), "n")
    hot = _frequent(words, hot_words).toArrow()
    key = hot.column("word").to_numpy().astype(np.uint64)
    order = np.argsort(key)
    lps = values(counts.where(F.col("kind") == GRAM).select(F.col("key").alias("gram"), "n", "m"), scratch)
    often = _frequent(lps, hot_grams).toArrow()
    rising = np.argsort(often.column("n").to_numpy(), kind="stable")
    model = Model(often.column("gram").to_numpy()[rising].astype(np.uint64), often.column("lp").to_numpy()[rising],
                  key[order], np.log10(hot.column("n").to_numpy()[order] + 1.0), rows,
                  (total.get(WORD) or (0, 0))[0] + rows, (total.get(WORD) or (0, 0))[1] + (rows > 0))
    return model, words, lps


class Scorer:
    """Sums of log10 probabilities of the hot grams by row, and the other grams with
    their times. Hot grams that share a slot leave it to the most frequent one;
    the others are joined like all that are not hot."""

    def __init__(self, m: Model):
        self.m = m
        self.key = np.full(1 << CACHE_BITS, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.value = np.zeros(1 << CACHE_BITS)
        at = self._slot(m.gram)
        self.key[at], self.value[at] = m.gram, m.lp

    @staticmethod
    def _slot(g: np.ndarray) -> np.ndarray:
        return (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CACHE_BITS)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """-> (score of each row, other grams by row, times of each, how many each row has)."""
        g, first, last = grams(data, offsets)
        coded, row = _rows_of(g, first, last)
        g = g[coded]
        slot = self._slot(g)
        hit = self.key[slot] == g
        score = np.bincount(row, weights=np.where(hit, self.value[slot], 0.0), minlength=len(first))
        g, row = g[~hit], row[~hit]
        order = np.lexsort((g, row))
        g, row = g[order], row[order]
        at = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (row[1:] != row[:-1])))) if len(g) else np.zeros(0, int)
        return score, g[at], np.diff(np.append(at, len(g))), np.bincount(row[at], minlength=len(first))


_scorers: dict = {}


def _scorer(shared) -> Scorer:
    """One scorer a worker and broadcast."""
    if shared.bid not in _scorers:
        _scorers.clear()
        _scorers[shared.bid] = Scorer(shared.value)
    return _scorers[shared.bid]


class _Shared:
    """A broadcast with a name of its own."""

    def __init__(self, spark, value: Model):
        import uuid

        self.bid = uuid.uuid4().hex
        self.broadcast = spark.sparkContext.broadcast(value)

    @property
    def value(self) -> Model:
        return self.broadcast.value


def _score(shared: _Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared)
        m = scorer.m
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            score = np.zeros(batch.num_rows)
            tokens, known, hot_log = (np.zeros(batch.num_rows, k) for k in (np.int64, np.int64, float))
            rest, times, lengths, other, often, others = [], [], [], [], [], []
            for a, b, w in X.word_chunks(batch.column("text")):
                score[a:b], g, c, k = scorer(w.data, w.offsets)
                other.append(g), often.append(c), others.append(k)
                for r in range(b - a):
                    u, c = np.unique(w.hash[w.first[r]:w.first[r + 1]], return_counts=True)
                    at = np.minimum(np.searchsorted(m.hot, u), max(0, len(m.hot) - 1))
                    hit = m.hot[at] == u if len(m.hot) else np.zeros(len(u), bool)
                    tokens[a + r] = c.sum() + 1
                    known[a + r] = c[hit].sum()
                    hot_log[a + r] = (c[hit] * m.hot_log[at[hit]]).sum()
                    rest.append(u[~hit]), times.append(c[~hit]), lengths.append(int((~hit).sum()))
            n = np.array(lengths, np.int64)
            flat = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
                    for x in (rest, times, other, often, others)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(batch.num_rows)), batch.column("doc_id"), pa.array(tokens), pa.array(known),
                 pa.array(hot_log), pa.array(score), X.list_column(flat[0], n, pa.int64()),
                 X.list_column(flat[1], n, pa.int64()), X.list_column(flat[2], flat[4], pa.int64()),
                 X.list_column(flat[3], flat[4], pa.int64())],
                ["row", "doc_id", "n_tokens", "known", "hot_log", "score", "words", "times", "grams", "often"])
            row += batch.num_rows

    return run


def score(docs: DataFrame, train_on: Column) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, n_tokens,
    n_known, train_tokens, base_score, score (log10 of the model's probability
    of the text; over the number of bytes it is the code length per byte).

    The rows for which ``train_on`` holds are learnt from. A null text is
    empty. Without training rows all decisions have probability one half and
    the base is 0. A null doc_id or repeated rows make no difference to a
    row's score; an empty table gives an empty result.
    """
    scratch = C.Scratch(docs.sparkSession, "ctw")
    model, words, lps = train(docs, train_on, scratch)
    found = scratch.written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                            .mapInArrow(_score(_Shared(docs.sparkSession, model)),
                                        "row long, doc_id long, n_tokens long, known long, hot_log double, score double, "
                                        "words array<long>, times array<long>, grams array<long>, often array<long>"), "rows")
    rest = (found.select("row", F.explode(F.arrays_zip("words", "times")).alias("x"))
            .select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
            .join(words, "word").groupBy("row")
            .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_log")))
    others = (found.select("row", F.explode(F.arrays_zip("grams", "often")).alias("x"))
              .select("row", F.col("x.grams").alias("gram"), F.col("x.often").alias("often"))
              .join(lps.select("gram", "lp"), "gram").groupBy("row")
              .agg(F.sum(F.col("often") * F.col("lp")).alias("more_score")))
    n, v, rows = model.tokens, model.distinct, model.rows
    base = (F.col("hot_log") + F.coalesce("more_log", F.lit(0.0)) + float(np.log10(rows + 1))
            - F.col("n_tokens") * float(np.log10(n + v + 1)))
    return scratch.last(
        found.drop("words", "times", "grams", "often").join(rest, "row", "left").join(others, "row", "left")
        .select("doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0)) + int(rows > 0)).alias("n_known"),
                F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"),
                (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score")))
