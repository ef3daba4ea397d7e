"""Token ids as wavelet matrices, one compressed file per shard.

Documents are dealt to shards by ranges of doc_id. A task sorts its shard's
documents, encodes them, appends the end id to each, and stacks the bit planes
of all ids: plane 0 holds the highest bits in text order, and each further
plane holds the next bit after a stable partition by the one before. With a
directory of set bits per block, ``access``, ``rank``, ``select`` and counting
need one step a plane, and the whole text comes back from the planes alone.

A shard is one row of a Parquet file of its own (zstd): n, bits, zeros and
planes and ranks by plane, and the documents' ids and lengths.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as X

SHARD_BYTES = 16 << 20
BLOCK = 512
CACHED_WORDS = 1_200_000

SCHEMA = ("shard int, n long, bits int, zeros array<long>, planes array<binary>, ranks array<binary>, "
          "doc_ids array<long>, lengths array<int>")


class WaveletMatrix:
    """Rank and select over a sequence of unsigned integers below 2**bits."""

    def __init__(self, n: int, bits: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.bits, self.zeros = n, bits, list(zeros)
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, np.uint32) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        zeros, planes, ranks = [], [], []
        for level in range(bits - 1, -1, -1):
            one = (ids & ids.dtype.type(1 << level)).astype(bool)
            packed = np.packbits(one, bitorder="little")
            padded = np.zeros(-(-len(ids) // BLOCK) * BLOCK // 8, np.uint8)
            padded[:len(packed)] = packed
            per_block = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate(([0], np.cumsum(per_block))).astype(np.uint32).tobytes())
            planes.append(packed.tobytes())
            ids = np.concatenate((ids[~one], ids[one]))
            zeros.append(len(one) - int(one.sum()))
        return cls(len(ids), bits, zeros, planes, ranks)

    def _ones(self, plane: int, i: int) -> int:
        """Set bits before position i of a plane."""
        b = i // BLOCK
        part = np.unpackbits(self.planes[plane][b * BLOCK // 8:-(-i // 8)], bitorder="little")[:i - b * BLOCK]
        return int(self.ranks[plane][b]) + int(part.sum())

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][i >> 3] >> (i & 7)) & 1

    def access(self, i: int) -> int:
        """The id at position i."""
        value = 0
        for p in range(self.bits):
            bit, ones = self._bit(p, i), self._ones(p, i)
            value = value << 1 | bit
            i = self.zeros[p] + ones if bit else i - ones
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for p in range(self.bits):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = ((self.zeros[p] + a, self.zeros[p] + b) if value >> (self.bits - 1 - p) & 1
                      else (lo - a, hi - b))
        return lo, hi

    def rank(self, value: int, i: int) -> int:
        """Occurrences of a value before position i."""
        lo, hi = self._range(value, 0, i)
        return hi - lo

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a value in positions lo to hi."""
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def select(self, value: int, k: int) -> int:
        """The position of the k-th occurrence (from 0) of a value."""
        lo, hi = self._range(value, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for p in range(self.bits - 1, -1, -1):
            one = value >> (self.bits - 1 - p) & 1
            want = i - self.zeros[p] if one else i
            a, b = 0, self.n  # the position whose bit is the (want + 1)-th of its kind
            while a < b:
                m = (a + b) // 2
                ones = self._ones(p, m + 1)
                if (ones if one else m + 1 - ones) <= want:
                    a = m + 1
                else:
                    b = m
            i = a
        return i

    def all(self) -> np.ndarray:
        """The whole sequence: the partitions undone from the last plane to the first."""
        value = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for p in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[p], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(value)
            above[~one] = value[:self.zeros[p]]
            above[one] = value[self.zeros[p]:] | value.dtype.type(1 << self.bits - 1 - p)
            value = above
        return value


class Encoder:
    """Ids of texts by a tokenizer file. If the tokenizer drops white space (which
    is probed), words between ASCII white space never share a token, so that each
    distinct word is encoded once by the tokenizers library and remembered (up to a
    bound); otherwise texts are encoded whole.

    A word of Latin letters, with or without one mark behind it, is one piece
    (and one for the mark) for the library's normaliser and pre-tokenizer, and
    goes to the library's merges directly; what the pieces look like is asked
    of the library letter by letter. All other words go through the whole
    tokenizer, and so does every word if a probe shows any difference.
    """

    MARKS = ".,!?;:"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bits = max(1, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.kind = np.dtype("<u2") if self.bits <= 16 else np.dtype("<u4")
        self.code = "H" if self.bits <= 16 else "I"
        self._forget()
        letters = [chr(c) for c in range(256) if chr(c).isalpha()]
        self.letters = {ord(c): self._piece(c) for c in letters}
        self.plain = all(self.letters[ord(c)] == c.lower() for c in letters if c.isascii())
        self.marks = {m: self._whole([m])[0] for m in self.MARKS}
        probes = [f"{a}{c}{b}{m}" for c in letters for a, b, m in (("", "", ""), ("ab", "Cd", "."), ("stre", "s", ","))]
        self.direct = all(self.letters.values()) and [self._merged(p) for p in probes] == self._whole(probes)
        pairs = [(a, b) for a, b in zip(probes[::7], probes[3::7])]
        self.apart = all(self._whole([f"{x}{a}{gap}{b}{x}"]) == [self._whole([a])[0] + self._whole([b])[0]]
                         for a, b in pairs for gap, x in ((" ", ""), ("  ", " "), ("\n", ""), ("\t", "\r"), ("\x0b", ""), ("\x0c", "")))
        shifted = [p.swapcase() for p in probes if p.isascii()]
        self.folds = self._whole(shifted) == self._whole([p for p in probes if p.isascii()])

    def _forget(self) -> None:
        """Nothing remembered: words by hash, a second hash, and where their ids lie in ``flat``."""
        self.hash, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.size, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.round = np.zeros(0, self.kind), 0

    def _piece(self, letter: str) -> str:
        t = self.tokenizer
        text = t.normalizer.normalize_str(letter) if t.normalizer else letter
        pieces = t.pre_tokenizer.pre_tokenize_str(text) if t.pre_tokenizer else [(text, None)]
        return pieces[0][0] if len(pieces) == 1 else ""

    def _whole(self, words: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in done]

    def _merged(self, word: str) -> bytes | None:
        """The ids of a word of Latin letters and perhaps a mark, else None."""
        mark = b""
        if word[-1] in self.marks:
            word, mark = word[:-1], self.marks[word[-1]]
        if not word.isalpha():
            return None
        if not word.isascii():
            if max(word) > "\xff":
                return None
            word = word.translate(self.letters)
        else:
            word = word.lower() if self.plain else word.translate(self.letters)
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes() + mark

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        found, rest = {}, words
        if self.direct:
            rest = []
            for w in words:
                ids = self._merged(w.decode("utf-8", "replace"))
                if ids is None:
                    rest.append(w)
                else:
                    found[w] = ids
        found.update(zip(rest, self._whole([w.decode("utf-8", "replace") for w in rest])))
        return found

    def _remember(self, h: np.ndarray, check: np.ndarray, ids: list[bytes]) -> None:
        """File words by their hashes. When there are too many, half of them go, those that
        were met least lately."""
        size = np.array(list(map(len, ids)), np.int64) // self.kind.itemsize
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(ids), self.kind)))
        cols = [np.concatenate(x) for x in ((self.hash, h), (self.check, check), (self.begin, begin), (self.size, size),
                                            (self.used, np.full(len(h), self.round)))]
        order = np.argsort(cols[0], kind="stable")
        if len(order) > CACHED_WORDS:
            keep = np.zeros(len(order), bool)
            now = int((cols[4] == self.round).sum())  # the words at hand stay
            keep[np.argsort(cols[4], kind="stable")[-max(CACHED_WORDS // 2, now):]] = True
            order = order[keep[order]]
            begin, size = cols[2][order], cols[3][order]
            stop = np.cumsum(size)
            self.flat = self.flat[np.repeat(begin - (stop - size), size) + np.arange(int(stop[-1]))]
            cols[2][order] = stop - size
        self.hash, self.check, self.begin, self.size, self.used = (c[order] for c in cols)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each row of UTF-8 texts.

        Words are told apart by two 64-bit hashes; A-Z count as a-z only if the
        tokenizer lower-cases them too.
        """
        if not self.apart:
            raw = data.tobytes()
            return [np.frombuffer(x, self.kind) for x in
                    self._whole([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])])]
        w = X.words(data, offsets, check=True) if self.folds else X.words(data, offsets, check=True, fold=False)
        if not len(w.hash):
            return [np.zeros(0, self.kind)] * (len(offsets) - 1)
        h, at, back = np.unique(w.hash, return_index=True, return_inverse=True)
        check = w.check[at]
        known = np.zeros(len(h), bool)
        if len(self.hash):
            spot = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            known = self.hash[spot] == h
        clash = not (check[back] == w.check).all() or known.any() and not (self.check[spot[known]] == check[known]).all()
        if clash:  # two words of one hash: row by row, or word by word
            if len(offsets) > 2:
                return [x for r in range(len(offsets) - 1)
                        for x in self(data[offsets[r]:offsets[r + 1]], offsets[r:r + 2] - offsets[r])]
            raw = data.tobytes().split()
            return [np.frombuffer(b"".join(self._learn([x])[x] for x in raw), self.kind)]
        self.round += 1
        if known.any():
            self.used[spot[known]] = self.round
        if not known.all():
            new = np.flatnonzero(~known)
            raw, start, end = data.tobytes(), w.start[at[new]].tolist(), w.end[at[new]].tolist()
            word = [raw[a:b] for a, b in zip(start, end)]
            learnt = self._learn(word)
            self._remember(h[new], check[new], [learnt[x] for x in word])
        spot = np.searchsorted(self.hash, h)
        begin, each = self.begin[spot][back], self.size[spot][back]
        stop = np.zeros(len(each) + 1, np.int64)
        np.cumsum(each, out=stop[1:])
        ids = self.flat[np.repeat(begin - stop[:-1], each) + np.arange(stop[-1])]
        return np.split(ids, stop[w.first[1:-1]])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _build(tokenizer: str, end_id: int):
    def one(shard: int, ids: list[int | None], parts: list[np.ndarray], bits: int) -> pa.RecordBatch:
        m = WaveletMatrix.build(np.concatenate(parts), bits)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([m.n], pa.int64()), pa.array([bits], pa.int32()),
             pa.array([m.zeros], pa.list_(pa.int64())),
             pa.array([[p.tobytes() for p in m.planes]], pa.list_(pa.binary())),
             pa.array([[r.tobytes() for r in m.ranks]], pa.list_(pa.binary())),
             pa.array([ids], pa.list_(pa.int64())), pa.array([list(map(len, parts))], pa.list_(pa.int32()))],
            ["shard", "n", "bits", "zeros", "planes", "ranks", "doc_ids", "lengths"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        bits = max(encode.bits, end_id.bit_length())
        end = np.array([end_id], np.uint16 if bits <= 16 else np.uint32)
        now, ids, parts = None, [], []
        for batch in batches:
            data, off = X.string_buffers(batch.column("text"))
            shards, docs = batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in X.chunks(off):
                done = encode(data[off[a]:off[b]], off[a:b + 1] - off[a])
                for shard, doc, row in zip(shards[a:b], docs[a:b], done):
                    if shard != now and parts:
                        yield one(now, ids, parts, bits)
                        ids, parts = [], []
                    now = shard
                    ids.append(doc)
                    parts.append(np.concatenate((row, end)))
        if parts:
            yield one(now, ids, parts, bits)

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) to wavelet matrices under ``path``, one file per shard.

    Shards are ranges of doc_id of about ``shard_bytes`` of text (equal
    numbers of rows; a null doc_id comes first, and rows of one doc_id stay
    together). A null text is empty and has the end id alone. An empty table
    leaves a folder without shards.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    shards = max(1, -(-size // shard_bytes))
    cuts = []
    if shards > 1:  # one number a shard
        cuts = (docs.agg(F.percentile_approx("doc_id", [k / shards for k in range(1, shards)],
                                             max(10_000, 50 * shards)).alias("c")).first()["c"] or [])
    cuts = np.array(cuts, np.int64)
    tagged = docs.select("doc_id", "text")

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc_id")
            where = np.searchsorted(cuts, doc.fill_null(-(1 << 63)).to_numpy(), "left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(where), doc, batch.column("text")], ["shard", "doc_id", "text"])

    if len(cuts) <= 1000:  # as an expression
        shard = F.lit(0)
        if len(cuts):
            limits = F.array(*[F.lit(int(c)) for c in cuts])
            shard = F.when(F.col("doc_id").isNull(), 0).otherwise(
                F.size(F.filter(limits, lambda c: c < F.col("doc_id"))))
        tagged = tagged.select(shard.cast("int").alias("shard"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    else:
        tagged = tagged.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            tag, "shard int, doc_id long, text string")
    # a partition a shard, so that no two meet in a task
    rows = (tagged.repartitionById(int(shards), "shard").sortWithinPartitions("shard", "doc_id", "text")
            .mapInArrow(_build(tokenizer, end_id), SCHEMA))
    (rows.withColumn("file", F.col("shard")).write.mode("overwrite").option("compression", "zstd")
     .partitionBy("file").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The shards under ``path``, one row each."""
    return spark.read.schema(SCHEMA).parquet(path)


def matrix(row: dict) -> WaveletMatrix:
    """The wavelet matrix of a shard's row."""
    return WaveletMatrix(row["n"], row["bits"], row["zeros"], row["planes"], row["ranks"])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            ids = matrix(row).all().astype("<u4")
            stop = np.cumsum(row["lengths"])
            start = stop - row["lengths"]
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(start, stop)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * len(crc), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                 pa.array(start, pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])


def documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of
    every document, from the ids that the files give back."""
    shards = read(spark, path)
    before = (shards.select("shard", "n")  # a row a shard
              .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before")))
    return (shards.mapInArrow(_documents, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
            .join(before, "shard")
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """doc_id and n, the token's count in each document that has it, counted by
    rank at the documents' borders without reading the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                m = matrix(row)
                border = np.concatenate(([0], np.cumsum(row["lengths"])))
                at = np.diff([m.rank(token, int(b)) for b in border]) if m.count(token) else np.zeros(len(border) - 1)
                has = np.flatnonzero(at)
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][i] for i in has], pa.int64()),
                                                  pa.array(at[has].astype(np.int64))], ["doc_id", "n"])

    return read(spark, path).mapInArrow(run, "doc_id long, n long")
