"""Source divergence audit: how far the term shares of sources lie apart.

A document's terms are runs of ASCII letters and characters beyond ASCII, A-Z
as a-z. Each language keeps the terms that at least ``min_docs`` of its documents
have. A term's share in a group is p = 1 + floor(10**9 * (count + 2) / (N + 2V)),
N the group's occurrences of kept terms and V the number of kept terms; two
shares differ by f = floor((p - q)**2 / (p + q)).

*Counting.* Tasks count the terms of many texts, by codes and one sort of these,
before anything is shuffled; the counts are then dealt by (lang, term), which also decides what is kept, so that
a frequent term is a row a task and no group of documents is brought together.

*Terms that stand out.* f depends on a term only through its counts in the group
and in the language. Terms are grouped into cells by these two counts, f is
evaluated once a cell, cells of equal value are merged, and ranked by cumulative
multiplicity: the cells that reach into the first ``top`` ranks are expanded into
their terms, ties in UTF-8 order.

*Pairs of sources.* Kept terms are dealt to blocks of bounded size; a block merges
terms of equal shares into cells with a multiplicity, adds up f for each pair of
sources cell by cell, and blocks are summed per pair. Nothing is joined all with all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import plan_utils as pu
from . import common as C

#: Terms that a task counts at a time (by the bytes of their texts), and counts of a block of terms.
HELD_TERMS = 2_800_000
TERM_BYTES = 6
BLOCK_COUNTS = 100_000
CELLS = 1 << 20

_KIND = "lang string, source string, part string, item string, value long, rank int"

#: What ends a term becomes a space, A-Z become a-z; bytes beyond ASCII stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _split(texts: pa.Array) -> pa.ListArray:
    """The terms of each text, and empty strings at the ends of some."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2])[at[0]:at[-1]].tobytes().translate(_TABLE)
    return pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(data)))


def _sums(block: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (lang, source, term, n, docs) of a block: its words as codes
    of (group, term, document), sorted once."""
    lang, source, text = (block.column(c).cast(pa.string()) for c in ("lang", "source", "text"))
    lists = _split(text)
    words = lists.flatten().dictionary_encode()
    term, kinds = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
    doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    empty = words.dictionary.index("").as_py()
    if empty >= 0:
        doc, term = doc[term != empty], term[term != empty]
    if not len(term):
        return
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    code = group[doc]     # in place: a block's words are held a few times, not ten
    code *= kinds
    code += term
    code *= len(lists)
    code += doc
    del doc, term
    code.sort()
    first = np.concatenate(([True], code[1:] != code[:-1]))
    cell = code // len(lists)
    start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    group, term = cell[start] // kinds, cell[start] % kinds
    columns = [langs.dictionary.take(pa.array(group // len(sources.dictionary))),
               sources.dictionary.take(pa.array(group % len(sources.dictionary))), words.dictionary.take(pa.array(term)),
               pa.array(np.diff(np.append(start, len(code)))), pa.array(np.add.reduceat(first.astype(np.int64), start))]
    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (lang, source, term, n, docs), summed over blocks of texts of a task."""
    held: list[pa.RecordBatch] = []
    size, most = 0, HELD_TERMS * TERM_BYTES
    for batch in batches:
        # the texts' bytes tell where a block ends
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most - size, side="right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1]) - before
            at = to
            if size >= most or at < len(ends):
                yield from _sums(pa.concat_batches(held))
                held, size = [], 0
    if held:
        yield from _sums(pa.concat_batches(held))


def _share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * kinds)), exactly."""
    return (F.call_function("div", (count + 2).cast("decimal(20,0)") * F.lit(10 ** 9).cast("decimal(11,0)"),
                            (total + 2 * kinds).cast("decimal(20,0)")) + 1).cast("long")


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)) of two shares; shares are below 2**30, squares below 2**60."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def counted(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """(lang, source, term, n, lang_n, head): occurrences of every kept term in each group that has it
    and in its language; ``head`` marks one row of each (lang, term)."""
    text = (docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                        F.col("text").cast("string").alias("text")).where("text <> ''"))
    # one shuffle, by (lang, term), serves the sums of groups and of languages
    of_group = (text.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
                .repartition(F.col("lang"), F.col("term")).groupBy("lang", "term", "source")
                .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    of_lang = Window.partitionBy("lang", "term")
    return (of_group.withColumn("lang_n", F.sum("n").over(of_lang)).withColumn("lang_docs", F.sum("docs").over(of_lang))
            .withColumn("head", F.row_number().over(of_lang.orderBy("source")) == 1)
            .where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "head"))


def group_sizes(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, kinds, entries) of every group that occurs:
    N of the group and of its language, V, and the language's rows of ``counts``."""
    groups = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                         F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).distinct()
    of_lang = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum(F.col("head").cast("long")).alias("kinds"),
                                         F.count(F.lit(1)).alias("entries"))
    of_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    return (groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
            .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "kinds", "entries")]))


def standing_out(counts: DataFrame, sizes: DataFrame, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): the terms that a group has more of than its language."""
    cells = counts.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("times"))
    valued = (cells.join(sizes, ["lang", "source"])
              .withColumn("p", _share(F.col("n"), F.col("total"), F.col("kinds")))
              .withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("kinds")))
              .where("p > q").withColumn("value", _apart(F.col("p"), F.col("q")))
              .select("lang", "source", "n", "lang_n", "times", "value"))
    group = Window.partitionBy("lang", "source")
    down = group.orderBy(F.col("value").desc())
    # every merged value has a term at least: the first ``top`` values hold the first ``top`` ranks
    merged = (valued.groupBy("lang", "source", "value").agg(F.sum("times").alias("times"))
              .withColumn("k", F.row_number().over(down)).where(F.col("k") <= top)
              .withColumn("before", F.sum("times").over(down.rowsBetween(Window.unboundedPreceding, -1)))
              .where(F.coalesce("before", F.lit(0)) < top).select("lang", "source", "value"))
    reached = valued.join(merged, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value")
    return (counts.join(reached, ["lang", "source", "n", "lang_n"])
            .withColumn("rank", F.row_number().over(group.orderBy(F.col("value").desc(), "term")))
            .where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def pair_sums(key: tuple, shares: pd.DataFrame, groups: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """One block of a language's terms: the sum of f over them for every ordered pair of sources.

    ``shares``: term, source, p where the count is above 0; ``groups``: source, p0 (the share
    of a term that does not occur). Work goes by rows of terms, so memory is bounded by
    CELLS numbers beside the block."""
    groups = groups.sort_values("source")
    sources, zero = groups["source"].to_numpy(), groups["p0"].to_numpy(np.int64)
    place = pd.Index(sources).get_indexer(shares["source"])
    term, _ = pd.factorize(shares["term"])
    kinds = int(term.max()) + 1 if len(term) else 0
    order = np.argsort(term, kind="stable")
    term, place, p = term[order], place[order], shares["p"].to_numpy(np.int64)[order]
    total = np.zeros((len(sources), len(sources)), np.int64) if len(sources) ** 2 <= 4 * CELLS else None
    step = max(1, CELLS // max(1, len(sources)))

    def frame(g: int, row: np.ndarray) -> pd.DataFrame:
        other = np.arange(len(sources)) != g
        return pd.DataFrame({"lang": key[0], "source": sources[g], "item": sources[other], "value": row[other]})

    for a in range(0, kinds, step):
        lo, hi = np.searchsorted(term, (a, a + step))
        dense = np.repeat(zero[None, :], min(step, kinds - a), axis=0)
        dense[term[lo:hi] - a, place[lo:hi]] = p[lo:hi]
        cells, times = np.unique(dense, axis=0, return_counts=True)
        for g in range(len(sources)):
            mine = cells[:, g:g + 1]
            row = (((mine - cells) ** 2 // (mine + cells)) * times[:, None]).sum(axis=0)
            if total is None:
                yield frame(g, row)
            else:
                total[g] += row
    if total is not None and kinds:
        for g in range(len(sources)):
            yield frame(g, total[g])


def between_sources(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the language, by how far its shares lie apart."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("entries") / BLOCK_COUNTS)).cast("int")
    shares = (counts.join(sizes, ["lang", "source"])
              .select("lang", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), "source", "term",
                      _share(F.col("n"), F.col("total"), F.col("kinds")).alias("p")))
    # of languages that keep terms: the groups, once for each block
    dealt = (sizes.where("kinds > 0")
             .select("lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "source",
                     _share(F.lit(0).cast("long"), F.col("total"), F.col("kinds")).alias("p0")))

    def block(key: tuple, mine: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        found = list(pair_sums(key, mine, groups))
        return pd.concat(found) if found else pd.DataFrame({"lang": [], "source": [], "item": [], "value": []})

    summed = (shares.groupBy("lang", "block").cogroup(dealt.groupBy("lang", "block"))
              .applyInPandas(block, "lang string, source string, item string, value long")
              .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    # languages without kept terms: the sums are 0
    bare = sizes.where("kinds = 0").select("lang", "source")
    none = (bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
            .select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    down = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (summed.unionByName(none).withColumn("rank", F.row_number().over(down))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank for every group (lang, source) of ``docs``.

    Part ``pair`` ranks all other sources of the language by the summed f; part
    ``term`` the first ``top`` kept terms of which the group has a larger share than
    its language, by f. Ranks go by value, largest first, then by the item's UTF-8
    bytes. Null text, lang and source count as ''. A row is a document, repeated
    rows too; other columns are ignored. A group without terms has pairs all the
    same; a source alone in its language has none; a language that keeps no term
    has pairs of value 0. An empty table gives an empty result.
    """
    counts = C.written(counted(docs, min_docs), "divergence-counts")
    sizes = C.written(group_sizes(docs, counts), "divergence-groups")
    sizes = pu.small(sizes, sizes.count())  # one row a group: broadcast while they are few
    return standing_out(counts, sizes, top).unionByName(between_sources(counts, sizes))
