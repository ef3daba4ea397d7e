"""Line dedup by shared rare lines and pairwise patience alignment.

*Lines* are cut by content, so that a passage pasted into other text has the same
lines there wherever its own lines end: runs of ``LINE`` words, of which the one
with the smallest hash among each ``REACH`` successive ones is taken. Lines that
only one document has are dropped by a count. A line that several have may be
common, so it ties nobody by itself: the ``BLOCK`` words up to its end and from its
start on, which are rare, do. Each of these points at the earliest document
(smallest doc_id) that has it: a passage in a million documents gives a million
pairs, not all pairs among them.

*Alignment.* For each pair, the later document's shared runs are aligned by patience
diff: the longest chain that is in order in both. Runs of the chain that join up
are blocks of common words. What the chain leaves out is out of order; it is aligned
again by itself, and what comes of that counts only if it is a passage that has moved
(``PASSAGE`` words). Blocks grow word by word to the ends of what the two have in
common, against the words beside the earlier document's place. The words of all
blocks are deleted from the later document.

Any ``PASSAGE`` = REACH + LINE - 1 successive words that an earlier document has hold a
line whose words to one side lie within them, so every such passage is found. Frequent
runs are joined in shares (``SALTS``), so that no task has all documents of one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import text as X
from .line_dedup import _rewrite, patience, run_keys

LINE = 13
REACH = 25
BLOCK = 25
PASSAGE = REACH + LINE - 1
#: Words that a block may grow by on either side: within more there would be another shared run.
BESIDE = PASSAGE - BLOCK
#: Rows of a run from which it is joined in shares; at least so many, and so few keys.
HOT_ROWS = 10_000
HOT_KEYS = 100_000
SALTS = 16


def lines(w: X.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, hash) of the lines that are taken; words count from the chunk's first."""
    n = np.diff(w.first)
    many = np.maximum(0, n - LINE + 1)
    row = np.repeat(np.arange(len(n)), many)
    none = np.zeros(0, np.int64)
    if not len(row):
        return none, none, none.astype(np.uint64)
    begin = np.cumsum(many) - many
    at = np.arange(len(row)) - begin[row] + w.first[:-1][row]
    h = run_keys(w, at, at + LINE)
    low, have = h.copy(), 1
    while have < REACH:  # the smallest of ``have`` from each on
        step = min(have, REACH - have)
        low[:len(low) - step] = np.minimum(low[:len(low) - step], low[step:])
        have += step
    whole = np.arange(len(row)) - begin[row] + REACH <= many[row]  # windows within a row
    best, have = np.where(whole, low, 0), 1
    while have < REACH:  # the largest of such minima over the windows that hold a line
        step = min(have, REACH - have)
        best[step:] = np.maximum(best[step:], best[:len(best) - step])
        have += step
    taken = best == h
    some = np.flatnonzero(many > 0)
    least = np.repeat(np.minimum.reduceat(h, begin[some]), many[some])
    taken |= (many[row] < REACH) & (h == least)
    at, row, h = at[taken], row[taken], h[taken]
    # of a line that comes again and again, one in each stretch
    _, once = np.unique(np.stack([row.astype(np.uint64), h, ((at - w.first[row]) // REACH).astype(np.uint64)]), axis=1,
                        return_index=True)
    once.sort()
    return row[once], at[once], h[once]


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, print, text) -> a row a line: (key, doc_id, print, at, words, before, after): its place, and the
    hashes of the runs up to its end and from its start on; of short texts also the whole."""
    for batch in batches:
        doc, print_ = batch.column("doc_id"), batch.column("print")
        for a, _, w in X.word_chunks(batch.column("text")):
            row, at, h = lines(w)
            n = np.diff(w.first)
            start = at - (BLOCK - LINE)
            has = [start >= w.first[row], at + BLOCK <= w.first[row + 1]]
            keys = [np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)]
            for k, first in enumerate((start, at)):
                keys[k][has[k]] = run_keys(w, first[has[k]], first[has[k]] + BLOCK).astype(np.int64)
            short = np.flatnonzero((n > 0) & (n < PASSAGE))
            whole = run_keys(w, w.first[short], w.first[short + 1])
            rows = pa.array(np.concatenate((row, short)) + a)
            place = np.concatenate((at - w.first[row], np.zeros(len(short), np.int64)))
            gone = np.concatenate((~has[0], np.ones(len(short), bool))), np.concatenate((~has[1], np.zeros(len(short), bool)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((h, X.mix(whole ^ X.const(211)))).astype(np.int64)), doc.take(rows), print_.take(rows),
                 pa.array(place.astype(np.int32)), pa.array(np.concatenate((np.full(len(at), BLOCK), n[short])).astype(np.int32)),
                 pa.array(np.concatenate((keys[0], np.zeros(len(short), np.int64))), mask=gone[0]),
                 pa.array(np.concatenate((keys[1], whole.astype(np.int64))), mask=gone[1])],
                ["key", "doc_id", "print", "at", "words", "before", "after"])


_FILED = "key long, doc_id long, print int, at int, words int, before long, after long"


def _in_shares(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``keyed`` (one row a key, with its number of rows n); keys of many rows in shares."""
    total = keyed.agg(F.sum("n")).first()[0] or 0
    # fewer than HOT_KEYS keys can have as many rows
    hot = keyed.where(F.col("n") > max(HOT_ROWS, total // HOT_KEYS)).select(key, F.lit(True).alias("hot"))
    share = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0).cast("int")
    shares = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = rows.join(F.broadcast(hot), key, "left").withColumn("salt", share).drop("hot")
    spread = keyed.drop("n").join(F.broadcast(hot), key, "left").withColumn("salt", F.explode(shares)).drop("hot")
    return salted.join(spread, [key, "salt"]).drop("salt")


def aligned(first: list[int], other: list[int], words: list[int]) -> list[tuple[int, int, int, bool]]:
    """(first word, last word, earlier text's first word, out of order) of the blocks of a pair.
    Its shared runs, sorted by place: word ``first`` on, ``words`` many, equal word ``other`` on there."""
    out: list[tuple[int, int, int, bool]] = []
    again = False
    while first:
        chain = patience(first, other)
        for k in chain:
            a, b, o = first[k], first[k] + words[k] - 1, other[k]
            if out and out[-1][3] == again and out[-1][2] - out[-1][0] == o - a and out[-1][0] <= a <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2], again)
            else:
                out.append((a, b, o, again))
        taken = set(chain)
        left = [k for k in range(len(first)) if k not in taken
                and not any(a <= first[k] and first[k] + words[k] - 1 <= b for a, b, _, _ in out)]
        first, other, words = ([x[k] for k in left] for x in (first, other, words))
        again = True
    return out


_BLOCKS = "doc_id long, print int, owner long, oprint int, first int, last int, other int, again boolean"


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (doc_id, print, owner, oprint, at): the runs that a pair shares -> its blocks."""
    names = [part.split()[0] for part in _BLOCKS.split(", ")]

    def blocks(rows: list[np.ndarray]) -> pa.RecordBatch:
        pair, (at, other, words) = rows[:4], rows[4:]
        fresh = np.ones(len(at), bool)
        fresh[1:] = np.any([c[1:] != c[:-1] for c in pair], axis=0)
        group = np.cumsum(fresh) - 1
        back = np.zeros(len(at), bool)
        back[1:] = ~fresh[1:] & (other[1:] < other[:-1])
        crossed = np.zeros(int(group[-1]) + 1, bool)
        crossed[group[back]] = True
        # pairs in order throughout: all of their runs are one chain
        plain = ~crossed[group]
        head = fresh.copy()
        head[1:] |= (other[1:] - at[1:] != other[:-1] - at[:-1]) | (at[1:] > at[:-1] + words[:-1])
        h = np.flatnonzero(head & plain)
        ends = np.maximum.reduceat(np.where(plain, at + words - 1, -1), np.flatnonzero(head))[np.cumsum(head)[h] - 1]
        cols = [[c[h]] for c in pair] + [[at[h]], [ends], [other[h]], [np.zeros(len(h), bool)]]
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(at))
        for g in np.flatnonzero(crossed):
            a, b = first[g], last[g]
            found = aligned(at[a:b].tolist(), other[a:b].tolist(), words[a:b].tolist())
            for k, c in enumerate(pair):
                cols[k].append(np.full(len(found), c[a]))
            for k in range(4):
                cols[4 + k].append(np.array([x[k] for x in found]))
        kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 4, pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(cols, kinds)], names)

    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "print", "owner", "oprint", "at", "other", "words")]
        rows = [np.concatenate(x) for x in zip(*held, rows)] if held else rows
        # the last pair may go on
        differs = np.flatnonzero(np.any([c[:-1] != c[-1] for c in rows[:4]], axis=0))
        cut = int(differs[-1]) + 1 if len(differs) else 0
        if cut:
            yield blocks([c[:cut] for c in rows])
        held = [[c[cut:] for c in rows]]
    if held:
        yield blocks(held[0])


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the places that blocks point at -> the hashes of the words beside each: those before it,
    the nearest first, and those after it."""
    for batch in batches:
        doc, print_, places = (batch.column(c) for c in ("owner", "oprint", "places"))
        out: list[tuple] = []
        for a, b, w in X.word_chunks(batch.column("text")):
            for r in range(a, b):
                lo, hi = int(w.first[r - a]), int(w.first[r - a + 1])
                for p in places[r].as_py():
                    x, y = lo + p["other"], lo + p["olast"] + 1
                    out.append((r, p["other"], p["olast"], w.hash[max(lo, x - BESIDE):x][::-1].tobytes(),
                                w.hash[y:min(hi, y + BESIDE)].tobytes()))
        rows = pa.array([r[0] for r in out], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [doc.take(rows), print_.take(rows), *(pa.array([r[k] for r in out], pa.int32()) for k in (1, 2)),
             *(pa.array([r[k] for r in out], pa.binary()) for k in (3, 4))],
            ["owner", "oprint", "other", "olast", "left", "right"])


def _common(mine: np.ndarray, other: np.ndarray) -> int:
    """How many words two sequences begin with in common."""
    n = min(len(mine), len(other))
    differ = np.flatnonzero(mine[:n] != other[:n])
    return int(differ[0]) if len(differ) else n


def grown(hashes: np.ndarray, blocks: list[dict]) -> list[int]:
    """First and last words, flat and in order, of what is deleted of a text."""
    found = []
    for x in blocks:
        left, right = (np.frombuffer(x[c], np.uint64) for c in ("left", "right"))
        a, b = x["first"], x["last"]
        a -= _common(hashes[max(0, a - len(left)):a][::-1], left)
        b += _common(hashes[b + 1:b + 1 + len(right)], right)
        if not x["again"] or b - a + 1 >= min(PASSAGE, len(hashes)):
            found.append((a, b))
    merged: list[list[int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1] + 1:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return [x for m in merged for x in m]


def _delete(texts: pa.Array, blocks: pa.Array) -> list[pa.Array]:
    has = pc.is_valid(blocks).to_numpy(zero_copy_only=False)
    out: list = [None] * len(texts)
    if has.any():
        at = np.flatnonzero(has)
        for a, b, w in X.word_chunks(texts.take(pa.array(at))):
            for r in range(a, b):
                mine = w.hash[w.first[r - a]:w.first[r - a + 1]]
                out[at[r]] = grown(mine, blocks[int(at[r])].as_py()) or None
    return _rewrite(texts, pa.array(out, pa.list_(pa.int32())), False)


def _blocks(texts: DataFrame, kept: C.Scratch) -> DataFrame:
    """(doc_id, print, blocks) of the documents that share runs with earlier ones."""
    scratch = C.Scratch(texts.sparkSession, "line-align")
    filed = texts.mapInArrow(_file, _FILED)
    shared = scratch.written(filed.select("key", "doc_id").groupBy("key").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
        .where("low < top").select("key", "n"), "lines")
    C.release(texts.sparkSession)
    run = F.explode(F.array(F.struct(F.col("before").alias("run"), (F.col("at") - (BLOCK - LINE)).alias("at")),
                            F.struct(F.col("after").alias("run"), F.col("at"))))
    runs = scratch.written(_in_shares(filed, shared, "key").select("doc_id", "print", "words", run.alias("r"))
                           .select("r.run", "doc_id", "print", "r.at", "words").where("run is not null"), "runs")
    C.release(texts.sparkSession)
    place = F.shiftleft(F.col("print").cast("long"), 32).bitwiseOR(F.col("at").cast("long"))
    owners = scratch.written(runs.select("run", "doc_id", place.alias("place")).groupBy("run").agg(
        F.min("doc_id").alias("owner"), F.min_by("place", "doc_id").alias("place"), F.max("doc_id").alias("top"),
        F.count(F.lit(1)).alias("n")).where("owner < top").select("run", "owner", "place", "n"), "owners")
    matches = (_in_shares(runs, owners, "run").where("doc_id > owner")
               .select("doc_id", "print", "owner", F.shiftright("place", 32).cast("int").alias("oprint"), "at",
                       F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("other"), "words"))
    order = ("doc_id", "print", "owner", "oprint", "at", "other")
    blocks = scratch.written(matches.repartition("doc_id", "print", "owner").sortWithinPartitions(*order)
                             .mapInArrow(_align, _BLOCKS).withColumn("olast", F.col("other") + F.col("last") - F.col("first")), "blocks")
    C.release(texts.sparkSession)
    places = (blocks.select("owner", "oprint", "other", "olast").distinct().groupBy("owner", "oprint")
              .agg(F.collect_list(F.struct("other", "olast")).alias("places")))
    beside = (texts.select(F.col("doc_id").alias("owner"), F.col("print").alias("oprint"), "text").join(places, ["owner", "oprint"])
              .mapInArrow(_beside, "owner long, oprint int, other int, olast int, left binary, right binary")
              .dropDuplicates(["owner", "oprint", "other", "olast"]))  # rows that repeat a document
    out = kept.written(blocks.join(beside, ["owner", "oprint", "other", "olast"]).groupBy("doc_id", "print")
                       .agg(F.collect_list(F.struct("first", "last", "again", "left", "right")).alias("blocks")), "cuts")
    scratch.drop()
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` (by place: c0, c1, ...) with the cut text in
    place of ``text``, and removed_lines, the number of lines of which words were deleted.

    Null texts stay as they are; a row without doc_id is left alone and owns nothing; rows of
    one doc_id do not cut each other. A text of fewer than ``PASSAGE`` words goes if an
    earlier one equals it word by word. Empty tables give empty results.
    """
    names = docs.columns
    safe = [f"c{i}" for i in range(len(names))]
    d, t = safe[names.index("doc_id")], safe[names.index("text")]
    plain = docs.toDF(*safe)
    mark = F.hash(t)
    texts = plain.where(F.col(d).isNotNull() & F.col(t).isNotNull()).select(
        F.col(d).cast("long").alias("doc_id"), mark.alias("print"), F.col(t).cast("string").alias("text"))
    blocks = _blocks(texts, C.Scratch(docs.sparkSession, "line-cuts"))
    joined = (plain.join(blocks, (F.col(d) == F.col("doc_id")) & (mark == F.col("print")), "left")
              .drop("doc_id", "print"))
    kind = joined.drop("blocks").schema
    k = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.columns[:-1]
            cols[k], gone = _delete(cols[k], batch.columns[-1])
            yield pa.RecordBatch.from_arrays([*cols, gone], [*safe, "removed_lines"])

    return joined.mapInArrow(run, kind.add("removed_lines", "long"))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, text (what is left of it) and removed_lines for every row."""
    names = docs.columns
    return deduplicated(docs).select(F.col(f"c{names.index('doc_id')}").alias("doc_id"),
                                     F.col(f"c{names.index('text')}").alias("text"), "removed_lines")


def drop_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with cut texts (and n_chars, if there, as they now are), without the rows of
    whose text nothing was left."""
    names = docs.columns
    text = F.col(f"c{names.index('text')}")
    out = deduplicated(docs).where((F.col("removed_lines") == 0) | (F.trim(text) != ""))
    if "n_chars" in names:
        c = f"c{names.index('n_chars')}"
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(c, F.when(F.col("removed_lines") > 0, F.length(text).cast(kind)).otherwise(F.col(c)))
    return out.drop("removed_lines").toDF(*names)
