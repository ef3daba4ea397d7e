"""Line dedup by pairwise alignment.

A text is cut in lines: at line breaks, after words that end a sentence, and
after about every 32nd word as its own hash says, so that a passage pasted into
other text falls into the same lines there. A line by itself may be common;
runs of lines of at least ``min_words`` words are the rare hashes by which
documents find each other. Each such run points at the earliest document
(smallest doc_id) that has it, so that a run in a million documents gives a
million pairs, not all pairs among them.

Each pair is aligned by patience diff: the shared runs that the later document
has, in its order, and the longest chain of them that is in the earlier one's
order too; then again with what is left, so that passages which changed places
align as well. The aligned common blocks are deleted from the later document.

Without ``whole_lines`` (as the queries use it) the same is done word by word:
every window of ``min_words`` words is a run, so that blocks end at the very
words at which texts part, wherever their lines end. Few windows are filed: each
has an anchor, the smallest hash among its shorter runs of words, which is the
same wherever the window stands, and only windows whose anchor another document
has too are looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import text as X

MIN_WORDS = 25

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def lines(w: X.Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of every line, and first line of every row (one longer than rows)."""
    n = len(w.hash)
    rows = len(w.first) - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
    breaks = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(w.data == 10, out=breaks[1:])
    stop = _ENDS[w.data[w.end - 1]] | ((w.hash & np.uint64(31)) == 0)
    stop[:-1] |= breaks[w.start[1:]] > breaks[w.end[:-1]]
    begin = np.empty(n, bool)
    begin[0] = True
    begin[1:] = stop[:-1]
    begin[w.first[:-1][w.first[:-1] < n]] = True
    first = np.flatnonzero(begin)
    return first, np.searchsorted(first, w.first)


def runs(w: X.Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, first line, last line) of the shortest run of whole lines from
    each line on that has ``min_words`` words. The k-th of equal runs in a text
    has a key of its own, so that keys are unique within a text."""
    first, of_row = lines(w)
    none = np.zeros(0, np.int64)
    if not len(first):
        return none.astype(np.uint64), none, none, none
    row = np.repeat(np.arange(len(of_row) - 1), np.diff(of_row))
    stop = np.append(first[1:], len(w.hash))
    last = np.searchsorted(stop, first + min_words, "left")
    ok = last < of_row[1:][row]
    at, last, row = np.flatnonzero(ok), last[ok], row[ok]
    if not len(at):
        return none.astype(np.uint64), none, none, none
    key = run_keys(w, first[at], stop[last])
    order = np.lexsort((key, row))
    k, r = key[order], row[order]
    fresh = np.concatenate(([True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])))
    place = np.arange(len(k))
    nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
    key[order] = X.mix(k + nth.astype(np.uint64) * X.const(201))
    return key, row, at - of_row[row], last - of_row[row]


def _anchor_words(min_words: int) -> int:
    return (min_words + 1) // 2


def windows(w: X.Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, words, anchor, group) of every window of ``min_words``
    words; a shorter text is one window and its own anchor. Words count from the
    chunk's first; equal windows have equal anchors. A group is the first window
    of those in a row that have one anchor."""
    n, size = np.diff(w.first), _anchor_words(min_words)
    many = np.maximum(0, n - min_words + 1)
    row = np.repeat(np.arange(len(n)), many)
    at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + w.first[:-1][row]
    key = np.zeros(0, np.uint64)
    if len(at):
        start = np.arange(len(w.hash) - size + 1)
        low, have, reach = run_keys(w, start, start + size), 1, min_words - size + 1
        while have < reach:  # the smallest of ``have`` runs from each word on
            step = min(have, reach - have)
            low, have = np.minimum(low[:-step], low[step:]), have + step
        key = low[at]
    short = np.flatnonzero((n > 0) & (n < min_words))
    if len(short):
        a = w.first[:-1][short]
        row, at, key = np.append(row, short), np.append(at, a), np.append(key, run_keys(w, a, a + n[short]))
    fresh = np.ones(len(at), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    group = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
    return row, at, np.minimum(min_words, n[row]), key, group


def run_keys(w: X.Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of the words a to b - 1, for each a and b."""
    power = X.powers(len(w.hash) + 1)
    inverse = _inverse_powers(len(w.hash) + 1)
    total = np.zeros(len(w.hash) + 1, np.uint64)
    np.cumsum(w.hash * power[:len(w.hash)], out=total[1:])
    return X.mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64))


_inverse = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        base = int(X.powers(2)[1])
        out = np.full(max(n, 2 * len(_inverse), 1024), np.uint64(pow(base, -1, 1 << 64)), np.uint64)
        out[0] = 1
        _inverse = np.multiply.accumulate(out)
    return _inverse


def _file_runs(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, print_ = batch.column("doc_id"), batch.column("print")
            for a, b, w in X.word_chunks(batch.column("text")):
                key, row, first, last = runs(w, min_words)
                at = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.astype(np.int64)), doc.take(at), print_.take(at), pa.array(first.astype(np.int32)),
                     pa.array(last.astype(np.int32))], ["key", "doc_id", "print", "first", "last"])

    return run


def _file_anchors(min_words: int):
    """Arrow task: the anchors of each text's groups of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, print_ = batch.column("doc_id"), batch.column("print")
            for a, _, w in X.word_chunks(batch.column("text")):
                row, first, _, key, group = windows(w, min_words)
                one = np.flatnonzero(first == group)
                at = pa.array(row[one] + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[one].astype(np.int64)), doc.take(at), print_.take(at),
                     pa.array((first[one] - w.first[row[one]]).astype(np.int32))], ["key", "doc_id", "print", "anchor"])

    return run


def _file_windows(min_words: int):
    """Arrow task: the windows of each text that have one of its ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, print_, anchors = batch.column("doc_id"), batch.column("print"), batch.column("anchors")
            for a, b, w in X.word_chunks(batch.column("text")):
                mine = anchors.slice(a, b - a)
                shared = np.zeros(len(w.hash), bool)
                shared[mine.flatten().to_numpy() + np.repeat(w.first[:-1], pc.list_value_length(mine).to_numpy())] = True
                row, first, size, _, group = windows(w, min_words)
                take = np.flatnonzero(shared[group])
                row, first, size = row[take], first[take], size[take]
                at, place = pa.array(row + a), first - w.first[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(run_keys(w, first, first + size).astype(np.int64)), doc.take(at), print_.take(at),
                     pa.array(place.astype(np.int32)), pa.array((place + size - 1).astype(np.int32))],
                    ["key", "doc_id", "print", "first", "last"])

    return run


def patience(mine: list[int], other: list[int]) -> list[int]:
    """Places of the longest chain of matches that goes up in both orders.
    ``mine`` is sorted and holds a line once; what it has more often than
    ``other`` has one place there and stays in one chain."""
    tops: list[int] = []
    held: list[int] = []
    back: list[int] = []
    for k, j in enumerate(other):
        p = bisect_right(tops, j)
        back.append(held[p - 1] if p else -1)
        if p == len(tops):
            tops.append(j), held.append(k)
        else:
            tops[p], held[p] = j, k
    out = []
    k = held[-1] if held else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def aligned_blocks(first: list[int], last: list[int], other: list[int]) -> list[tuple[int, int]]:
    """Blocks (first line, last line) of the later text that align with the
    earlier one: chains are taken until no match is left outside of them."""
    blocks = []
    while first:
        chain = patience(first, other)
        taken = set(chain)
        for k in chain:
            if blocks and blocks[-1][0] <= first[k] <= blocks[-1][1] + 1:
                blocks[-1] = (blocks[-1][0], max(last[k], blocks[-1][1]))
            else:
                blocks.append((first[k], last[k]))
        rest = [k for k in range(len(first)) if k not in taken
                and not any(a <= first[k] and last[k] <= b for a, b in blocks)]
        first, last, other = ([x[k] for k in rest] for x in (first, last, other))
    return blocks


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (doc_id, print, owner, first): matched runs -> deleted blocks of each document."""

    def one(key: tuple, pairs: dict) -> tuple:
        found = sorted(b for m in pairs.values() for b in aligned_blocks(*m))
        merged: list[list[int]] = []
        for a, b in found:
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        return (*key, [x for m in merged for x in m])

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["doc_id", "print", "blocks"])

    now, pairs, done = None, {}, []
    for batch in batches:
        for doc, mark, owner, first, last, other in zip(*(batch.column(c).to_pylist() for c in
                                                          ("doc_id", "print", "owner", "first", "last", "other"))):
            if (doc, mark) != now:
                if now is not None:
                    done.append(one(now, pairs))
                now, pairs = (doc, mark), {}
            f, la, o = pairs.setdefault(owner, ([], [], []))
            f.append(first), la.append(last), o.append(other)
        if len(done) > 4096:
            yield out(done)
            done = []
    if now is not None:
        done.append(one(now, pairs))
    yield out(done)


def _joined_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matched windows in the order of ``_align`` -> those of one pair that
    follow each other word by word, as one: all of them are common to both."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {c: batch.column(c).to_numpy() for c in ("doc_id", "print", "owner", "first", "last", "other")}
        goes_on = np.diff(cols["first"]) <= 1
        for c in ("doc_id", "print", "owner"):
            goes_on &= cols[c][1:] == cols[c][:-1]
        head = np.flatnonzero(np.concatenate(([True], ~goes_on)))
        tail = np.append(head[1:], batch.num_rows) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[c][tail if c == "last" else head]) for c in cols], list(cols))


def _cut(text: bytes, blocks: list[int], whole_lines: bool) -> tuple[bytes, int, int]:
    """The text without its blocks of lines (or words), its number of lines and
    of those of which words were deleted."""
    data = np.frombuffer(text, np.uint8)
    w = X.words(data, np.array([0, len(data)]))
    first, _ = lines(w)
    stop = np.append(first[1:], len(w.hash))
    parts, at, gone, seen = [], 0, 0, -1
    for a, b in zip(blocks[::2], blocks[1::2]):
        if whole_lines:
            a, b = int(first[a]), int(stop[b]) - 1
        begin, end = int(w.start[a]), int(w.end[b])
        after = int(w.start[b + 1]) if b + 1 < len(w.hash) else len(text)
        new_line = begin == 0 or b"\n" in text[int(w.end[a - 1]) if a else 0:begin]
        if new_line or b"\n" not in text[end:after]:
            end = after
        parts.append(text[at:begin])
        top, low = (int(k) - 1 for k in np.searchsorted(first, [b, a], "right"))
        at, gone, seen = end, gone + top - max(low, seen + 1) + 1, top
    parts.append(text[at:])
    return b"".join(parts), len(first), gone


def _rewrite(texts: pa.Array, blocks: pa.Array, whole_lines: bool) -> list[pa.Array]:
    n = np.zeros(len(texts), np.int64)
    gone = np.zeros(len(texts), np.int64)
    has = np.flatnonzero(pc.is_valid(blocks).to_numpy(zero_copy_only=False))
    new = []
    for r in has:
        cut, n[r], gone[r] = _cut(texts[int(r)].as_py().encode(), blocks[int(r)].as_py(), whole_lines)
        new.append(cut.decode("utf-8", "replace"))
    mask = np.zeros(len(texts), bool)
    mask[has] = True
    return [pc.replace_with_mask(texts, pa.array(mask), pa.array(new, texts.type)), pa.array(gone)]


def _shared_windows(texts: DataFrame, min_words: int) -> DataFrame:
    """(key, doc_id, print, first, last): all windows whose anchor two documents have."""
    filed = texts.mapInArrow(_file_anchors(min_words), "key long, doc_id long, print int, anchor int")
    shared = (filed.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top"))
              .where("low < top").select("key"))
    anchors = C.written(filed.join(shared, "key").groupBy("doc_id", "print")
                        .agg(F.collect_list("anchor").alias("anchors")), "line-anchors")
    C.release(texts.sparkSession)
    found = C.written(texts.join(anchors, ["doc_id", "print"])
                      .mapInArrow(_file_windows(min_words), "key long, doc_id long, print int, first int, last int"),
                      "line-windows")
    C.release(texts.sparkSession)
    return found


def _blocks(texts: DataFrame, min_words: int, whole_lines: bool) -> DataFrame:
    """(doc_id, print, blocks): what to delete from each later document of ``texts``."""
    if whole_lines:
        filed = texts.mapInArrow(_file_runs(min_words), "key long, doc_id long, print int, first int, last int")
    else:
        filed = _shared_windows(texts, min_words)
    owners = (filed.groupBy("key").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("top"),
                                       F.min_by("first", "doc_id").alias("other"))
              .where("owner < top").select("key", "owner", "other"))
    matches = filed.join(owners, "key").where("doc_id > owner").drop("key")
    task = _align if whole_lines else lambda batches: _align(_joined_windows(batches))
    return (matches.repartition("doc_id").sortWithinPartitions("doc_id", "print", "owner", "first")
            .mapInArrow(task, "doc_id long, print int, blocks array<int>"))


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, whole_lines: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` (by place: c0, c1, ...) with the cut
    text in place of ``text``, and removed_lines, the number of lines deleted.

    With ``whole_lines`` a block is deleted if it is a run of whole lines of at
    least ``min_words`` words that a document of smaller doc_id has too, the
    k-th of equal runs if that has k of them; short texts stay as they are.
    Without, every word is deleted that lies in a run of ``min_words`` words
    which a document of smaller doc_id has too, wherever in either and however
    often; a text of fewer words goes if an earlier one equals it word by word;
    removed_lines counts lines deleted in whole or in part.

    Null texts stay as they are; a row without doc_id is left alone and owns nothing; rows of
    one doc_id do not cut each other. Empty tables give empty results.
    """
    names = docs.columns
    safe = [f"c{i}" for i in range(len(names))]
    d, t = safe[names.index("doc_id")], safe[names.index("text")]
    plain = docs.toDF(*safe)
    mark = F.hash(t)
    blocks = C.written(_blocks(plain.where(F.col(d).isNotNull() & F.col(t).isNotNull())
                               .select(F.col(d).cast("long").alias("doc_id"), mark.alias("print"),
                                       F.col(t).alias("text")), min_words, whole_lines), "line-blocks")
    C.release(docs.sparkSession)
    joined = (plain.join(blocks, (F.col(d) == F.col("doc_id")) & (mark == F.col("print")), "left")
              .drop("doc_id", "print"))
    kind = joined.drop("blocks").schema
    k = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.columns[:-1]
            cols[k], gone = _rewrite(cols[k], batch.columns[-1], whole_lines)
            yield pa.RecordBatch.from_arrays([*cols, gone], [*safe, "removed_lines"])

    return joined.mapInArrow(run, kind.add("removed_lines", "long"))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, whole_lines: bool = True) -> DataFrame:
    """doc_id, text (what is left of it) and removed_lines for every row."""
    names = docs.columns
    return deduplicated(docs, min_words, whole_lines).select(
        F.col(f"c{names.index('doc_id')}").alias("doc_id"), F.col(f"c{names.index('text')}").alias("text"),
        "removed_lines")


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, whole_lines: bool = True) -> DataFrame:
    """``docs`` with cut texts (and n_chars, if there, as they now are), without
    the rows of whose text nothing was left."""
    names = docs.columns
    text = F.col(f"c{names.index('text')}")
    out = deduplicated(docs, min_words, whole_lines).where((F.col("removed_lines") == 0) | (F.trim(text) != ""))
    if "n_chars" in names:
        c = f"c{names.index('n_chars')}"
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(c, F.when(F.col("removed_lines") > 0, F.length(text).cast(kind)).otherwise(F.col(c)))
    return out.drop("removed_lines").toDF(*names)
