"""Toxicity: a linear classifier on character n-grams whose features are scaled
by naive Bayes log-count ratios.

A text's features are the distinct character n-grams (orders 3 and 4 of the
lower-cased text, hashed). The log-count ratio of an n-gram compares the
smoothed shares of toxic and other rows that hold it, over all labelled
training rows. The logistic regression on the scaled features is fitted by
follow-the-regularised-leader on a bounded sample: ``max_rows_per_class`` rows
of each label, those with the smallest hash of their id, weighted back to the
labels' true shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import linear
from . import text as X

ORDERS = (3, 4)
BITS = 18


@dataclass
class Model:
    weights: np.ndarray  # per slot, log-count ratio included
    bias: float


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros((2, 1 << BITS), np.int64)
    distinct = X.Distinct(BITS)
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for r, _, slots in X.row_slots(batch.column("text"), ORDERS, BITS):
            n[toxic[r], distinct(np.concatenate(slots))] += 1
    slot = np.flatnonzero(n.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(n[0][slot]), pa.array(n[1][slot])],
                                     ["slot", "clean", "toxic"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    distinct = X.Distinct(BITS)
    for batch in batches:
        found = [distinct(np.concatenate(s)) for _, _, s in X.row_slots(batch.column("text"), ORDERS, BITS)]
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), batch.column("mark"),
             X.list_column(flat, np.array(list(map(len, found)), np.int64), pa.int32())], ["toxic", "mark", "slots"])


def train(labelled: DataFrame, max_rows_per_class: int = 2000, alpha: float = 1.0) -> Model | None:
    """labelled: doc_id, text, toxic (0 or 1). None unless both labels occur.

    The labelled rows are written once; the counts and the sample read them."""
    rows = C.written(labelled.where("text is not null and toxic in (0, 1)")
                     .select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")), "toxic-rows")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}  # two rows
    if len(n) < 2:
        return None
    counts = np.zeros((2, 1 << BITS))
    table = (rows.select("text", "toxic").mapInArrow(_counts, "slot int, clean long, toxic long")
             .groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    at = table.column("slot").to_numpy()  # at most 2**BITS rows
    counts[0][at], counts[1][at] = table.column("clean").to_numpy(), table.column("toxic").to_numpy()
    ratio = np.log((alpha + counts[1]) / (2 * alpha + n[1])) - np.log((alpha + counts[0]) / (2 * alpha + n[0]))
    mark = F.xxhash64("doc_id")
    chosen = C.smallest_hashes(rows, n, "toxic", max_rows_per_class)
    # max_rows_per_class rows of either label at most: a bounded sample
    sample = (rows.join(F.broadcast(chosen), "doc_id").select("text", "toxic", mark.alias("mark"))
              .mapInArrow(_features, "toxic int, mark long, slots array<int>").toArrow())
    order = np.argsort(sample.column("mark").to_numpy(), kind="stable")
    label = sample.column("toxic").to_numpy()[order]
    slots = sample.column("slots").combine_chunks()
    features = []
    for k in order:
        i = slots[int(k)].values.to_numpy()
        features.append((i, ratio[i]))
    taken = np.bincount(label, minlength=2)
    share = np.array([n[0] / taken[0], n[1] / taken[1]])
    weight = (share / share.max())[label] ** 0.5
    w, b = linear.fit(features, label, 2, 1 << BITS, weight=weight, epochs=4, alpha=0.05, l1=1.0, l2=0.5)
    return Model(((w[:, 1] - w[:, 0]) * ratio).astype(np.float32), float(b[1] - b[0]))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` plus score (0 to 1; 0.5 without a model) and predicted. Only the text is read;
    a null text counts as empty. Earlier columns of those names are replaced."""
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS floats

    def task(texts: pa.Array) -> list[pa.Array]:
        m = shared.value or Model(np.zeros(1 << BITS, np.float32), 0.0)
        distinct = X.Distinct(BITS)
        z = np.array([m.weights[distinct(np.concatenate(s))].sum(dtype=np.float64)
                      for _, _, s in X.row_slots(texts, ORDERS, BITS)], float) + m.bias
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    return C.map_text(docs, task, "score double, predicted int").toDF(*docs.columns, "score", "predicted")


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; labels of
    rows whose crc32(doc_id) modulo ``folds`` is ``held_out`` are not looked at.

    A label that is null or neither 0 nor 1, or whose doc_id is null or has no
    document, teaches nothing; a document that is labelled several times
    teaches each label once. A row without doc_id is scored, its held_out is
    null. Without both labels every score is 0.5. Empty tables give empty
    results; other columns are ignored."""
    part = C.fold("doc_id", folds)
    known = labels.select("doc_id", "toxic").where(part != held_out).distinct()
    # by merge at every size: labels grow with the documents
    taught = docs.where(part != held_out).select("doc_id", "text").join(known.hint("merge"), "doc_id")
    return (predict(docs.select("doc_id", "text"), train(taught))
            .select("doc_id", (part == held_out).alias("held_out"), "score", "predicted"))
