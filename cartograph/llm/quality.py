"""Quality: a classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled
text. A text is cut in pieces of ``PIECE`` bytes, each compressed by itself with
either dictionary, so that what tells is the dictionary and not what a long text
has shown of itself before. The difference of the compressed sizes, divided by
the text's bytes, is the only feature; a logistic curve, fitted on labelled
texts that no dictionary has seen, makes a probability of it.

Everything is learnt from a bounded sample: of either label the
``max_rows_per_class`` rows with the smallest hash of their id. By a hash of the
text a quarter of them (copies together) is kept for the curve, of which whole
texts are compressed; of the others at most ``MOST_PIECES`` pieces of
``SAMPLE_BYTES``, spread over the text, go into the dictionary. Labels are
weighted back to their true shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

DICTIONARY_BYTES = 1 << 16
LEVEL = 3
PIECE = 1024
#: Of a sampled text: pieces that a dictionary is trained on, and their size.
MOST_PIECES = 8
SAMPLE_BYTES = 1024
#: Added to a text's bytes, so that a byte more or less says little of a few words.
FEW_BYTES = 32


@dataclass
class Model:
    good: bytes   # dictionaries
    bad: bytes
    slope: float
    offset: float


def trained_dictionary(pieces: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the pieces; of too few to train on, the pieces themselves."""
    try:
        return zstandard.train_dictionary(size, pieces, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held)


def sizes(text: bytes, good: bytes, bad: bytes) -> tuple[int, int]:
    """Compressed bytes of a text's pieces with either dictionary."""
    a, b = _compressor(good).compress, _compressor(bad).compress
    pieces = [text[k:k + PIECE] for k in range(0, len(text), PIECE)]
    return sum(len(a(x)) for x in pieces), sum(len(b(x)) for x in pieces)


def feature(n_bytes, good, bad):
    return (bad - good) / (n_bytes + FEW_BYTES)


def _measure(texts: pa.Array, good: bytes, bad: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, a, b = (np.zeros(len(texts), np.int64) for _ in range(3))
    for k, text in enumerate(texts.cast(pa.binary())):
        raw = text.as_py() or b""
        n[k] = len(raw)
        a[k], b[k] = sizes(raw, good, bad)
    return n, a, b


def spread_pieces(text: bytes, most: int = MOST_PIECES, size: int = SAMPLE_BYTES) -> list[bytes]:
    """At most ``most`` pieces of a text, evenly spread over all of it."""
    count = -(-len(text) // size)
    take = range(count) if count <= most else [k * count // most for k in range(most)]
    return [text[k * size:(k + 1) * size] for k in take]


def _sample_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [spread_pieces(t.as_py()) for t in batch.column("text").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("quality"), batch.column("mark"), pa.array(found, pa.list_(pa.binary()))],
            ["quality", "mark", "pieces"])


def _train_one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The dictionary of one label, of max_rows_per_class * MOST_PIECES pieces at most."""
    rows = rows.sort_values("mark", kind="stable")
    return pd.DataFrame({"quality": [key[0]], "dictionary": [trained_dictionary([p for x in rows["pieces"] for p in x])]})


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """(slope, offset) of the weighted logistic regression, by Newton's method on a scaled x."""
    scale = float(x.std()) or 1.0
    a = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        grad = a.T @ (weight * (p - y)) + ridge * w
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(curve, grad)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def train(docs: DataFrame, labels: DataFrame, max_rows_per_class: int = 1500) -> Model | float:
    """docs: doc_id, text; labels: doc_id, quality. A plain share where nothing can
    be compared: 0.5 without labelled text, else that of the good among the labels
    if one of them is missing."""
    known = labels.where("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    n = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}  # two rows
    if not n:
        return 0.5
    chosen = C.smallest_hashes(known, n, "quality", max_rows_per_class)
    chosen = known.join(F.broadcast(chosen), "doc_id")  # 2 * max_rows_per_class ids at most
    # an id's text is read once, the one of the smallest hash where an id has several
    rows = C.written(docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                     .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality")
                     .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
                     .withColumn("mark", F.xxhash64("doc_id"))
                     .withColumn("held", F.pmod(F.xxhash64("text", F.lit("held")), F.lit(4)) == 0), "quality-sample")
    books = (rows.where("not held").mapInArrow(_sample_pieces, "quality int, mark long, pieces array<binary>")
             .groupBy("quality").applyInPandas(_train_one, "quality int, dictionary binary"))
    found = {r["quality"]: bytes(r["dictionary"]) for r in books.collect()}  # two dictionaries
    if len(found) < 2:
        return float(n.get(1, 0)) / (n.get(0, 0) + n.get(1, 0)) if found else 0.5
    good, bad = found[1], found[0]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), *map(pa.array, _measure(batch.column("text"), good, bad))],
                ["quality", "n_bytes", "good", "bad"])

    # 2 * max_rows_per_class rows of four numbers at most
    curve = (rows.where("held").select("quality", "text")
             .mapInArrow(task, "quality int, n_bytes long, good long, bad long").orderBy("n_bytes", "good", "bad", "quality")
             .toPandas())
    y = curve["quality"].to_numpy(float)
    taken = np.bincount(curve["quality"].to_numpy(int), minlength=2)
    if not taken.all():  # too few rows: any text that fits one dictionary better is called so
        return Model(good, bad, 20.0, 0.0)
    weight = np.array([n[0] / taken[0], n[1] / taken[1]])
    weight = (weight / weight.max())[curve["quality"].to_numpy(int)]
    x = feature(curve["n_bytes"].to_numpy(float), curve["good"].to_numpy(), curve["bad"].to_numpy())
    return Model(good, bad, *logistic(x, y, weight))


def predict(docs: DataFrame, model: Model | float, least: float = 0.3) -> DataFrame:
    """``docs`` plus score (the probability of good quality), predicted (1 from ``least`` on) and the
    compressed sizes good_bytes and bad_bytes. Only the text is read; a null text counts as
    empty. Earlier columns of those names are replaced."""
    added = ["score", "predicted", "good_bytes", "bad_bytes"]
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries

    def task(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        if isinstance(m, float):
            p, a, b = np.full(len(texts), m), *np.zeros((2, len(texts)), np.int64)
        else:
            n, a, b = _measure(texts, m.good, m.bad)
            p = 1 / (1 + np.exp(-np.clip(m.slope * feature(n, a, b) + m.offset, -500, 500)))
        return [pa.array(p), pa.array((p >= least).astype(np.int32)), pa.array(a), pa.array(b)]

    return (C.map_text(docs, task, "score double, predicted int, good_bytes long, bad_bytes long")
            .toDF(*docs.columns, *added))


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, good_bytes, bad_bytes for every row of
    ``docs``; labels of rows whose crc32(doc_id) modulo ``folds`` is ``held_out``
    are not looked at.

    A label that is null or neither 0 nor 1, or whose doc_id is null or has no
    document, teaches nothing; a document labelled both ways teaches both. A row
    without doc_id is scored, its held_out is null; an empty text gets the score
    of no difference. Without labelled text every score is 0.5; with one label
    only, that label's share. Empty tables give empty results; other columns are
    ignored."""
    part = C.fold("doc_id", folds)
    model = train(docs.where(part != held_out), labels.where(part != held_out))
    return (predict(docs.select("doc_id", "text"), model, least)
            .select("doc_id", (part == held_out).alias("held_out"), "score", "predicted", "good_bytes", "bad_bytes"))
