"""Approximate nearest neighbours by learned partitions.

A bounded sample of vectors (``sample_rows``, those with the smallest hash of
their id) is joined to its neighbour graph; the graph is cut in balanced
partitions that keep neighbours together; a small network with one hidden
layer learns, from a vector, the shares of its neighbours in the partitions.
The network files every vector under its most probable partition and routes a
query to several most probable ones: as many as the sample's own queries need
for ``target_recall``. What the routing reaches is ranked by the exact
distance.

Partitions are dealt in blocks of bounded size by a hash of the id, and so are
the queries, so that a hot partition or vector is spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import text as X
from .linear import softmax

BLOCK_ROWS = 8192
BLOCK_QUERIES = 4096


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of every row of a bounded sample."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    norm = (x * x).sum(axis=1)
    for a in range(0, len(x), 512):
        d = norm[a:a + 512, None] + norm[None] - 2 * x[a:a + 512] @ x.T
        d[np.arange(len(d)), a + np.arange(len(d))] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        out[a:a + 512] = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1), 1)
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.05, sweeps: int = 8) -> np.ndarray:
    """A part for each row: halves along main directions to begin with, then
    rows move to the part that most of their neighbours are in while it has room."""
    part = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        g = groups.pop()
        c = x[g] - x[g].mean(axis=0)
        side = c @ np.linalg.svd(c[:1024], full_matrices=False)[2][0]
        order = np.argsort(side, kind="stable")
        groups += [g[order[:len(g) // 2]], g[order[len(g) // 2:]]]
    for k, g in enumerate(groups):
        part[g] = k
    a = np.repeat(np.arange(len(x)), graph.shape[1])
    room = int(np.ceil(len(x) / parts * (1 + slack)))
    for _ in range(sweeps):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (a, part[graph.ravel()]), 1)
        np.add.at(votes, (graph.ravel(), part[a]), 1)
        wish = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), wish] - votes[np.arange(len(x)), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[wish[i]] < room:
                size[part[i]] -= 1
                size[wish[i]] += 1
                part[i] = wish[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    center: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def probability(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.center) @ self.w1 + self.b1, 0)
        return softmax(h @ self.w2 + self.b2)


def fit_router(x: np.ndarray, shares: np.ndarray, hidden: int = 128, epochs: int = 40, seed: int = 5) -> Router:
    """A one-hidden-layer network from vectors to shares of partitions (Adam, cross entropy)."""
    rng = np.random.default_rng(seed)
    center = x.mean(axis=0)
    scale = np.sqrt(((x - center) ** 2).sum(axis=1).mean()) or 1.0
    z = (x - center) / scale
    p = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)) * x.shape[1] ** 0.5, np.zeros(hidden),
         rng.normal(0, (1 / hidden) ** 0.5, (hidden, shares.shape[1])), np.zeros(shares.shape[1])]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for a in range(0, len(z), 256):
            b = order[a:a + 256]
            h = np.maximum(z[b] @ p[0] + p[1], 0)
            d = (softmax(h @ p[2] + p[3]) - shares[b]) / len(b)
            dh = (d @ p[2].T) * (h > 0)
            grads = [z[b].T @ dh + 1e-4 * p[0], dh.sum(axis=0), h.T @ d + 1e-4 * p[2], d.sum(axis=0)]
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= 0.003 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return Router(center, p[0] / scale, p[1], p[2], p[3], 1)


def train(x: np.ndarray, parts: int, k: int, target_recall: float) -> Router:
    """The router of a bounded sample; a fifth of it is held back to choose the number of probes."""
    if len(x) < 4 * parts:
        one = fit_router(x, np.ones((len(x), 1)), hidden=1, epochs=0) if len(x) else None
        return one
    held = np.arange(len(x)) % 5 == 0
    base = x[~held]
    graph = neighbours(base, 10)
    part = balanced_partition(base, graph, parts)
    shares = np.zeros((len(base), parts))
    np.add.at(shares, (np.repeat(np.arange(len(base)), graph.shape[1]), part[graph.ravel()]), 1)
    shares[np.arange(len(base)), part] += 1
    shares /= shares.sum(axis=1, keepdims=True)
    router = fit_router(base, shares)
    filed = router.probability(base).argmax(axis=1)
    query = x[held]
    d = (query ** 2).sum(axis=1)[:, None] + (base ** 2).sum(axis=1)[None] - 2 * query @ base.T
    near = np.argpartition(d, min(k, len(base)) - 1, axis=1)[:, :k]
    rank = np.argsort(np.argsort(-router.probability(query), axis=1), axis=1)
    needed = np.take_along_axis(rank, filed[near], 1)  # the probe that reaches each neighbour
    recall = np.array([(needed < p).mean() for p in range(1, parts + 1)])
    router.probes = int(np.searchsorted(recall, min(target_recall, recall[-1]))) + 1
    return router


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), dims)


def _near(k: int, dims: int):
    def run(key, cand: pa.Table, quer: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        ids, qid = cand.column("vec_id").to_numpy(), quer.column("vec_id").to_numpy()
        if not len(ids) or not len(qid):
            return pa.table({n: pa.array([], t) for n, t in zip(names, (pa.int64(), pa.int64(), pa.float64()))})
        x, q = _vectors(cand.column("v"), dims), _vectors(quer.column("v"), dims)
        repeated = len(np.unique(ids)) < len(ids)
        norm = (x * x).sum(axis=1)
        out = ([], [], [])
        for a in range(0, len(q), 64):
            part = q[a:a + 64]
            rough = norm[None] + (part * part).sum(axis=1)[:, None] - 2 * part @ x.T
            for r, d in enumerate(rough):
                name = qid[a + r]
                if repeated or len(d) <= k + 1:
                    pick = np.arange(len(d))
                else:  # k and the query itself, and all that rounding could hide
                    edge = np.partition(d, k)[k]
                    pick = np.flatnonzero(d <= edge + 1e-9 * (1 + abs(norm).max()))
                pick = pick[ids[pick] != name]
                exact = np.sqrt(((x[pick] - part[r]) ** 2).sum(axis=1))
                order = np.lexsort((ids[pick], exact))
                if repeated:
                    _, first = np.unique(ids[pick][order], return_index=True)
                    order = order[np.sort(first)]
                order = order[:k]
                out[0].append(np.full(len(order), name)), out[1].append(ids[pick][order]), out[2].append(exact[order])
        return pa.table({n: pa.array(np.concatenate(v)) for n, v in zip(names, out)})

    return run


def search(vectors: DataFrame, is_query, k: int = 10, parts: int = 16, sample_rows: int = 4096,
           target_recall: float = 0.97) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance in double
    precision) of the nearest found of every row of ``vectors`` (vec_id,
    embedding) for which ``is_query`` holds, among all rows but those of its
    own vec_id; ties go to the smaller vec_id.

    Vectors that are null, empty, all zero or hold a null or a non-finite
    component, those of another length than the most frequent one, and rows
    without vec_id take no part. Rows that repeat a vec_id count once, by the
    nearest. A query has fewer than k rows only where there are fewer candidates
    in all. Other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    kind = "query_id long, rank int, vec_id long, score double"
    v = F.col("embedding").cast("array<double>")
    fine = (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) \
        & F.exists("v", lambda c: c != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), is_query.alias("is_query")) \
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine)
    top = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if top is None:
        return spark.createDataFrame([], kind)
    dims = top["dims"]
    rows = rows.where(F.size("v") == dims)
    sample = rows.select("v", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(sample_rows)
    router = train(_vectors(sample.toArrow().column("v"), dims), parts, k, target_recall)
    shared = spark.sparkContext.broadcast(router)

    def file(batches):
        r: Router = shared.value
        for batch in batches:
            p = r.probability(_vectors(batch.column("v"), dims))
            order = np.argsort(-p, axis=1, kind="stable").astype(np.int32)
            asks = batch.column("is_query").fill_null(False).to_numpy(zero_copy_only=False)
            kept = np.where(asks, order.shape[1], 1)  # only queries need more than their own partition
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), batch.column("is_query"),
                 X.list_column(order[np.arange(order.shape[1]) < kept[:, None]], kept.astype(np.int64), pa.int32())],
                ["vec_id", "v", "is_query", "ranking"])

    filed = C.written(rows.mapInArrow(file, "vec_id long, v array<double>, is_query boolean, ranking array<int>"),
                      "ann-filed")
    size = {r["part"]: r["n"] for r in filed.groupBy(F.col("ranking")[0].alias("part"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a partition
    blocks = F.create_map(*[F.lit(int(c)) for p, n in size.items() for c in (p, -(-n // BLOCK_ROWS))])
    others = {r["part"]: r["n"] for r in filed.groupBy("vec_id").agg(F.min(F.col("ranking")[0]).alias("part"))
              .groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # each vec_id in one partition
    held = F.create_map(*[F.lit(int(c)) for p in size for c in (p, others.get(p, 0))])
    # down the ranking until k others and the query itself must be among the candidates
    probes = F.aggregate(
        "ranking", F.struct(F.lit(0).cast("long").alias("ids"), F.lit(0).alias("used")),
        lambda got, part: F.when((got["used"] < router.probes) | (got["ids"] <= k), F.struct(
            (got["ids"] + F.coalesce(held[part], F.lit(0))).cast("long").alias("ids"),
            (got["used"] + 1).alias("used"))).otherwise(got),
        lambda got: F.slice("ranking", F.lit(1), got["used"]))
    asked = filed.where("is_query").count()
    shares = max(1, -(-asked // BLOCK_QUERIES))
    span = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cand = (filed.select("vec_id", "v", F.col("ranking")[0].alias("part"))
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks[F.col("part")]).cast("int"))
            .withColumn("share", span(F.lit(shares))))
    quer = (filed.where("is_query").select("vec_id", "v", F.explode(probes).alias("part"))
            .where(blocks[F.col("part")].isNotNull())
            .withColumn("share", F.pmod(F.xxhash64("vec_id"), F.lit(shares)).cast("int"))
            .withColumn("block", span(blocks[F.col("part")])))
    unit = ["part", "block", "share"]
    near = (cand.groupBy(*unit).cogroup(quer.groupBy(*unit))
            .applyInArrow(_near(k, dims), "query_id long, vec_id long, score double"))
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
