"""Language identification.

Sparse multinomial logistic regression on TF-IDF of character n-grams (orders
1 to 3 of the lower-cased text, hashed), fitted by
follow-the-regularised-leader with elastic-net penalties, then calibrated by a
temperature on rows held back from the fit.

Document frequencies come from all training rows. The classifier is fitted on
a bounded sample of them: ``max_rows`` rows in all, shared evenly among the
languages, those with the smallest hash of their id. Term frequency is the
n-gram's share of the text's n-grams, so a text's logits are sums over its
positions and texts of any length take memory by the megabyte.
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

ORDERS = (1, 2, 3)
BITS = 16
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # [slots, langs], idf and temperature included
    bias: np.ndarray


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(1 << BITS, np.int64)
    distinct = X.Distinct(BITS)
    for batch in batches:
        for _, _, slots in X.row_slots(batch.column("text"), ORDERS, BITS):
            df[distinct(np.concatenate(slots))] += 1
    slot = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(df[slot])], ["slot", "df"])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots, shares, lengths = [], [], []
        for _, _, s in X.row_slots(batch.column("text"), ORDERS, BITS):
            u, c = np.unique(np.concatenate(s), return_counts=True)
            slots.append(u), shares.append((c / max(1, c.sum())).astype(np.float32)), lengths.append(len(u))
        n = np.array(lengths, np.int64)
        flat = [np.concatenate(x) if x else np.zeros(0, k) for x, k in ((slots, np.int32), (shares, np.float32))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("mark"), X.list_column(flat[0], n, pa.int32()),
             X.list_column(flat[1], n, pa.float32())], ["lang", "mark", "slots", "shares"])


def train(docs: DataFrame, max_rows: int = 2000) -> Model | None:
    """The model of the rows with a text and a lang; None where there are none."""
    rows = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    per_lang = rows.groupBy("lang").count().orderBy("lang").collect()  # one row a language
    if not per_lang:
        return None
    langs = [r["lang"] for r in per_lang]
    total = sum(r["count"] for r in per_lang)
    quota = max(20, max_rows // len(langs))
    mark = F.xxhash64("doc_id")
    chosen = C.smallest_hashes(rows, {r["lang"]: r["count"] for r in per_lang}, "lang", quota)
    df = np.zeros(1 << BITS)
    for part in (rows.select("text").mapInArrow(_document_frequency, "slot int, df long")
                 .groupBy("slot").agg(F.sum("df").alias("df")).toLocalIterator()):  # at most 2**BITS rows
        df[part["slot"]] = part["df"]
    idf = np.log((1 + total) / (1 + df)) + 1
    # quota rows a language at most: a bounded sample
    sample = (rows.join(F.broadcast(chosen), "doc_id").select("text", "lang", mark.alias("mark"))
              .mapInArrow(_sample_features, "lang string, mark long, slots array<int>, shares array<float>")
              .toArrow())
    marks = sample.column("mark").to_numpy()
    order = np.argsort(marks, kind="stable")
    code = {k: i for i, k in enumerate(langs)}
    label = np.array([code[x] for x in sample.column("lang").to_pylist()])[order]
    slots, shares = sample.column("slots").combine_chunks(), sample.column("shares").combine_chunks()
    features = []
    for k in order:
        i = slots[int(k)].values.to_numpy()
        features.append((i, 10 * shares[int(k)].values.to_numpy().astype(float) * idf[i]))
    held = np.arange(len(label)) % 5 == 0
    held &= len(label) >= 10
    fitted = np.flatnonzero(~held)
    w, b = linear.fit([features[k] for k in fitted], label[fitted], len(langs), 1 << BITS)
    back = np.flatnonzero(held)
    logits = np.array([v @ w[i] + b for i, v in (features[k] for k in back)]).reshape(-1, len(langs))
    t = linear.temperature(logits, label[back])
    return Model(langs, (10 * idf[:, None] * w / t).astype(np.float32), b / t)


def _predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS x languages floats

    def task(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        is_letter = X.letters()
        pred, score = [], []
        for _, cp, slots in X.row_slots(texts, ORDERS, BITS):
            if m is None or not is_letter[cp].any():
                pred.append(UNKNOWN), score.append(0.0)
                continue
            z = sum(m.weights[s].sum(axis=0, dtype=np.float64) for s in slots)
            p = linear.softmax(z / max(1, sum(map(len, slots))) + m.bias)
            k = int(p.argmax())
            pred.append(m.langs[k]), score.append(float(p[k]))
        return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]

    return C.map_text(docs, task, "lang_pred string, score double")


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` plus lang_pred and score (the calibrated probability of lang_pred).

    ``und`` with score 0 for a null text, a text without any letter, or no
    model. Only the text is read. Earlier columns of those names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    return _predicted(docs, model).toDF(*docs.columns, "lang_pred", "score")


def identify(docs: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``; learnt from
    the rows whose crc32(doc_id) modulo ``folds`` is not ``held_out``.

    A row without doc_id teaches nothing (its held_out is null) and is
    predicted like any other; repeated rows are predicted each; an empty table
    gives an empty result."""
    part = C.fold("doc_id", folds)
    model = train(docs.where(part != held_out))
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", (part == held_out).alias("held_out"), "lang_pred", "score"))


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is identified with a probability of at least ``least``."""
    found = _predicted(docs, train(docs.where(C.fold("doc_id", 5) != 0)))
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.drop("lang_pred", "score").toDF(*docs.columns)
