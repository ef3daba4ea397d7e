"""Best-fit packing with conflicts.

Documents go to bins of ``capacity`` tokens (words and one end token). A bin
holds at most one document of a source and at most one of a cluster of equal
documents. A document longer than a bin is cut in pieces; all but its last
piece fill a bin.

Pieces are dealt to shards by a hash, about ``shard_rows`` to a shard, so that
a hot source spreads evenly; a shard is packed by itself, longest pieces first.
Its bins are ordered by residual and carry a bitmap of their sources and of the
clusters that occur twice in the shard. The search goes to the smallest
residual that fits and on to its successors until a compatible bin is found;
a tree over the residuals that holds the bits common to all bins below lets it
pass over bins that are all in conflict.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

CAPACITY = 2048
SHARD_ROWS = 4096
ALL = -1


class Bins:
    """Open bins by residual."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.width = 1 << capacity.bit_length()
        self.common = [ALL] * (2 * self.width)  # bits that all bins below have
        self.at: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]

    def _settle(self, residual: int) -> None:
        bits = ALL
        for b in self.at[residual]:
            bits &= b
        i = self.width + residual
        self.common[i] = bits
        while i > 1:
            i >>= 1
            bits = self.common[2 * i] & self.common[2 * i + 1]
            if self.common[i] == bits:
                break
            self.common[i] = bits

    def put(self, residual: int, bits: int, name: int) -> None:
        self.at[residual].setdefault(bits, []).append(name)
        self._settle(residual)

    def take(self, need: int, mask: int) -> tuple[int, int, int] | None:
        """(residual, bits, name) of the tightest bin with room for ``need`` and no
        bit of ``mask``; of several the one opened first. It leaves the order."""
        stack = [(1, 0, self.width)]
        while stack:
            node, lo, hi = stack.pop()
            if hi <= need or self.common[node] == ALL or self.common[node] & mask:
                continue
            if hi - lo == 1:
                fits = [b for b in self.at[lo] if not b & mask]
                if not fits:
                    continue
                bits = min(fits, key=lambda b: min(self.at[lo][b]))
                names = self.at[lo][bits]
                name = min(names)
                names.remove(name)
                if not names:
                    del self.at[lo][bits]
                self._settle(lo)
                return lo, bits, name
            mid = (lo + hi) // 2
            stack.append((2 * node + 1, mid, hi))
            stack.append((2 * node, lo, mid))
        return None


def pack_shard(pieces: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """pieces: (length, source, cluster), longest first -> (bin, offset) of each."""
    bit: dict[object, int] = {}
    often: set = set()
    once: set = set()
    for _, _, cluster in pieces:
        if cluster is not None:
            (often if cluster in once else once).add(cluster)
    bins, opened, out = Bins(capacity), 0, []
    for length, source, cluster in pieces:
        mask = 0
        if source is not None:
            mask |= 1 << bit.setdefault(("s", source), len(bit))
        if cluster in often:
            mask |= 1 << bit.setdefault(("c", cluster), len(bit))
        found = bins.take(length, mask)
        if found is None:
            found, opened = (capacity, 0, opened), opened + 1
        residual, bits, name = found
        out.append((name, capacity - residual))
        if residual > length:  # a full bin needs no place in the order
            bins.put(residual - length, bits | mask, name)
    return out


def _pack(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(shard: int, rows: list) -> pa.RecordBatch:
            where = pack_shard([(r[3], r[4], r[5]) for r in rows], capacity)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int32()),
                 pa.array([shard << 32 | b for b, _ in where], pa.int64()),
                 pa.array([o for _, o in where], pa.int32())],
                ["doc_id", "piece", "first_token", "n_tokens", "bin_id", "bin_offset"])

        now, rows = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in
                    ("shard", "doc_id", "piece", "first_token", "n_tokens", "source", "cluster")]
            for shard, *row in zip(*cols):
                if shard != now and rows:
                    yield out(now, rows)
                    rows = []
                now = shard
                rows.append(row)
        if rows:
            yield out(now, rows)

    return run


def tokens() -> "F.Column":
    """Words of the text and one end token."""
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text, source): doc_id, piece,
    first_token, n_tokens, bin_id, bin_offset.

    Bins hold at most ``capacity`` tokens, no source twice and no two equal
    texts. A null text is empty and takes its end token's place; a null source
    conflicts with none; rows with null or repeated doc_id are packed each.
    The number of shards follows the number of pieces. Other columns are
    ignored; an empty table gives an empty result.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    items = C.written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    F.xxhash64("text").alias("cluster"), F.col("text").isNull().alias("none"),
                    tokens().alias("length"))
        .select("doc_id", "source", F.when(~F.col("none"), F.col("cluster")).alias("cluster"), "length"), "pack-items")
    count = items.agg(F.sum(F.ceil(F.col("length") / capacity)).alias("n")).first()["n"] or 0
    shards = max(1, -(-int(count) // shard_rows))
    whole = F.explode(F.sequence(F.lit(0), (F.ceil(F.col("length") / capacity) - 1).cast("int")))
    pieces = (items.withColumn("piece", whole)
              .withColumn("first_token", F.col("piece").cast("long") * capacity)
              .withColumn("n_tokens", F.least(F.lit(capacity), F.col("length") - F.col("first_token")).cast("int"))
              .withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards)).cast("int")))
    return (pieces.repartition(shards, "shard")
            .sortWithinPartitions("shard", F.desc("n_tokens"), "doc_id", "piece", "cluster")
            .select("shard", "doc_id", "piece", "first_token", "n_tokens", "source", "cluster")
            .mapInArrow(_pack(capacity), "doc_id long, piece int, first_token long, n_tokens int, "
                                         "bin_id long, bin_offset int"))
