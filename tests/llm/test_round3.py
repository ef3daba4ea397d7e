"""Quality by compression, source divergence and periodic runs."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from llm_fixtures import docs_of  # noqa: F401

from cartograph.llm import divergence, periodic, quality


def _fold(i, n):
    return zlib.crc32(str(i).encode()) % n


# ---- periodic runs ------------------------------------------------------------------

def _runs_by_hand(w):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if length >= max(12, 2 * q):
                x = w[s:s + length]
                if not any(all(x[k] == x[k + r] for k in range(length - r)) for r in range(1, q)):
                    out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _row_by_hand(doc_id, text, plant=True):
    w = (text or "").encode().split()
    if plant and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _runs_by_hand(w)
    drop = [any(s + q <= i < s + n for s, n, q in runs) for i in range(len(w))]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (doc_id, len(runs), *(best + (1000 * best[1] // best[2],) if best else (None,) * 4),
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for x, d in zip(w, drop) if not d)).hexdigest())


def _random_text(rng):
    w = [f"w{rng.randrange(rng.choice([1, 2, 3, 8, 60]))}" for _ in range(rng.choice([0, 1, 5, 12, 13, 40, 130, 420]))]
    for _ in range(rng.randrange(4)):
        if len(w) > 3:
            a, q = rng.randrange(len(w)), rng.randrange(1, max(2, len(w) // 3))
            for i in range(a + q, min(len(w), a + q * rng.randrange(2, 6))):
                w[i] = w[i - q]
    return rng.choice([" ", "\n", " \t\x0b"]).join(w)


def test_runs_equal_brute_force(docs_of, monkeypatch):
    rng = random.Random(3)
    texts = [_random_text(rng) for _ in range(150)] + [None, "", " \n", "É é É é " * 6, "a " * 3000]
    docs = docs_of(texts)
    expected = sorted(_row_by_hand(i, t) for i, t in enumerate(texts))
    assert sorted(map(tuple, periodic.runs(docs, plant=True).collect())) == expected
    assert sum(r[1] > 0 for r in expected) > 30


def test_runs_over_slabs_and_in_long_texts(monkeypatch):
    rng = random.Random(5)
    base = [b"%d" % rng.randrange(50) for _ in range(3000)]
    long = base + base[:2500] + [b"x"] * 40 + base[700:900] * 3
    want = periodic._answer(long, _runs_by_hand(long))
    assert periodic.detect([long])[0] == want and want[0] >= 2
    monkeypatch.setattr(periodic, "SLAB_CELLS", 64)
    monkeypatch.setattr(periodic, "MOST_BLOCK", 16)  # blocks of bounded size answer for every distance
    assert periodic.detect([long, [b"y"], long])[2] == want


def test_transform_is_exact():
    rng = np.random.default_rng(0)
    for size in (4, 64, 256, 1 << 22):  # the last has the other modulus
        field = periodic.Field(size)
        x = rng.integers(0, 1000, (1, size)).astype(float)
        assert (field.inverse_transform(field.transform(x.copy())) == x).all()
    a, b = rng.integers(0, 300, 32), rng.integers(0, 300, 32)
    field = periodic.Field(64)
    pad = lambda x: np.concatenate([x, np.zeros(32)])[None].astype(float)
    both = field.reduced(field.transform(pad(a)) * field.transform(pad(b)))
    got = field.inverse_transform(both)[0] % field.prime
    assert (got[:63] == np.convolve(a, b) % field.prime).all()


def test_occurrences_miss_nothing():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(0, 3, 100), np.tile(rng.integers(0, 3, 21), 5)])
    size, many = len(x), 0
    for block in (2, 4, 8):
        found = {(int(p), int(d)) for at, ds in periodic.occurrences(x, block, range(2, 4)) for p, d in zip(at, ds)}
        true = {(p, d) for p in range(0, size, block) for d in range(2 * block, 4 * block)
                if p + d + block <= size and (x[p:p + block] == x[p + d:p + d + block]).all()}
        assert true <= found
        many += len(true)
    assert many > 20


def test_runs_edges(docs_of, spark):
    docs = docs_of(["a b " * 8, "a b " * 8, None, "a b " * 8], ids=[None, 7, 7, 7])
    rows = sorted(map(tuple, periodic.runs(docs, plant=True).collect()), key=str)
    assert rows == sorted([_row_by_hand(None, "a b " * 8), _row_by_hand(7, "a b " * 8), _row_by_hand(7, None),
                           _row_by_hand(7, "a b " * 8)], key=str)
    empty = docs.limit(0)
    assert periodic.runs(empty).collect() == [] and periodic.runs(empty).columns[0] == "doc_id"
    # a long text of one word, and one that repeats a long passage
    rng = random.Random(9)
    passage = " ".join(f"w{rng.randrange(4000)}" for _ in range(20000))
    rows = periodic.runs(docs_of(["x " * 60000, f"{passage} {passage}"])).orderBy("doc_id").collect()
    assert (rows[0]["n_runs"], rows[0]["length"], rows[0]["period"]) == (1, 60000, 1)
    assert (rows[1]["n_runs"], rows[1]["length"], rows[1]["period"]) == (1, 40000, 20000)


def test_collapse(docs_of):
    docs = docs_of(["say it " * 7 + "once", None, "plain text\nhere", ""]).withColumn("collapsed_text", F.lit(1))
    rows = periodic.collapse(docs).orderBy("doc_id").collect()
    assert [r["collapsed_text"] for r in rows] == ["say it once", None, "plain text here", ""]
    assert rows[0]["text"] == "say it " * 7 + "once"


# ---- source divergence ---------------------------------------------------------------

def _audit_by_hand(rows, min_docs, top):
    """rows: (text, lang, source)."""
    terms_of = []
    for text, lang, source in rows:
        found, now = [], b""
        for c in (text or "").encode() + b" ":
            if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128:
                now += bytes([c | 32]) if c < 128 else bytes([c])
            elif now:
                found.append(now.decode())
                now = b""
        terms_of.append((lang or "", source or "", Counter(found)))
    out = []
    for lang in {x[0] for x in terms_of}:
        mine = [x for x in terms_of if x[0] == lang]
        docs = Counter(t for _, _, c in mine for t in c)
        kept = sorted(t for t, d in docs.items() if d >= min_docs)
        v = len(kept)
        group = defaultdict(Counter)
        for _, s, c in mine:
            group[s].update({t: k for t, k in c.items() if t in set(kept)})
        whole = sum(group.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p, q = {s: share(c) for s, c in group.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in group:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in group if o != s]
            named = [(t, f(p[s][t], q[t])) for t in kept if group[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", named, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, x, k + 1) for k, (t, x) in enumerate(items[:most])]
    return sorted(out)


def _rows(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def _corpus(rng, n, vocabulary, langs=("en", "de", None), sources=("a", "b", "c", None, "hot")):
    words = [f"{rng.choice(['É', 'x', 'Q', 'ß', '漢'])}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(vocabulary)]
    rows = []
    for _ in range(n):
        s = "hot" if rng.random() < .4 else rng.choice(sources)
        k = rng.randrange(30)
        text = rng.choice([" ", "1", "-", "\n"]).join(rng.choice(words[:1 + int(len(words) * rng.random() ** 2)]) for _ in range(k))
        rows.append((rng.choice([text, text, text.upper(), None]), rng.choice(langs), s))
    return rows


@pytest.mark.parametrize("seed,min_docs,top,vocabulary", [(0, 3, 10, 60), (1, 10, 3, 12), (2, 1, 10, 200), (3, 500, 10, 40)])
def test_audit_equals_brute_force(docs_of, seed, min_docs, top, vocabulary):
    rows = _corpus(random.Random(seed), 260, vocabulary)
    docs = docs_of([r[0] for r in rows], langs=[r[1] for r in rows], sources=[r[2] for r in rows])
    assert _rows(divergence.audit(docs, min_docs, top)) == _audit_by_hand(rows, min_docs, top)


def test_audit_in_small_pieces(docs_of, monkeypatch):
    """Blocks of terms, chunks of a block, early hand-over: the same rows."""
    rows = _corpus(random.Random(4), 200, 80)
    docs = docs_of([r[0] for r in rows], langs=[r[1] for r in rows], sources=[r[2] for r in rows])
    monkeypatch.setattr(divergence, "BLOCK_COUNTS", 20)
    assert _rows(divergence.audit(docs, 2)) == _audit_by_hand(rows, 2, 10)
    batch = pa.RecordBatch.from_pydict({"lang": ["l"] * 50, "source": ["s", "t"] * 25, "text": ["A b. a", "é c"] * 25})
    whole = pa.Table.from_batches(divergence._count([batch])).to_pandas()
    monkeypatch.setattr(divergence, "HELD_TERMS", 2)
    parts = pa.Table.from_batches(divergence._count([batch, batch])).to_pandas()
    key = ["lang", "source", "term"]
    assert (parts.groupby(key).sum() == 2 * whole.groupby(key).sum()).all().all() and len(parts) > len(whole)


def test_pair_sums_without_a_square(monkeypatch):
    import pandas as pd

    shares = pd.DataFrame({"term": list("aabbc"), "source": ["s", "t", "t", "u", "s"], "p": [900, 50, 70, 70, 3]})
    groups = pd.DataFrame({"source": ["u", "s", "t"], "p0": [4, 5, 6]})
    one = pd.concat(divergence.pair_sums(("l", 0), shares, groups))
    monkeypatch.setattr(divergence, "CELLS", 2)
    many = pd.concat(divergence.pair_sums(("l", 0), shares, groups))
    assert len(many) > len(one) == 6
    key = ["lang", "source", "item"]
    assert many.groupby(key)["value"].sum().equals(one.groupby(key)["value"].sum())


def test_audit_edges(docs_of, spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(empty).collect() == []
    # a language that keeps nothing has pairs of value 0; a source alone has none
    docs = docs_of([None, "", "one", "two"], langs=["x", "x", "x", "y"], sources=["b", None, "a", "a"])
    assert _rows(divergence.audit(docs, 2)) == [
        ("x", "", "pair", "a", 0, 1), ("x", "", "pair", "b", 0, 2), ("x", "a", "pair", "", 0, 1), ("x", "a", "pair", "b", 0, 2),
        ("x", "b", "pair", "", 0, 1), ("x", "b", "pair", "a", 0, 2)]
    # repeated rows are documents each; a very long text
    docs = docs_of(["w " * 200000, "w v", "w v", "v"], ids=[1, 1, 1, 2], sources=["a", "a", "b", "b"])
    rows = [("w " * 200000, "en", "a"), ("w v", "en", "a"), ("w v", "en", "b"), ("v", "en", "b")]
    assert _rows(divergence.audit(docs, 3)) == _audit_by_hand(rows, 3, 10)


def test_audit_of_large_counts(spark):
    """Shares are exact where 10**9 times a count does not fit 64 bits."""
    n, total, kinds = 3 * 10 ** 13 + 7, 10 ** 14 + 1, 12345
    got = spark.range(1).select(divergence._share(F.lit(n).cast("long"), F.lit(total).cast("long"),
                                                  F.lit(kinds).cast("long"))).first()[0]
    assert got == 1 + 10 ** 9 * (n + 2) // (total + 2 * kinds)


# ---- quality -------------------------------------------------------------------------

def _labelled(spark, rng, n=240):
    good = ["quiet river walks past old stone houses", "she wrote a careful letter about the garden",
            "winter light falls over the harbour walls"]
    bad = ["BUY!! NOW!! CHEAP!! CLICK!!", "$$$ *** win *** $$$ prize &&& free", "aaa aaa aaa bbb bbb bbb"]
    docs, labels = [], []
    for k in range(n):
        y = int(rng.random() < .6)
        words = " ".join(rng.choice(good if y else bad) for _ in range(rng.randrange(2, 30))).split()
        rng.shuffle(words)
        docs.append((k, " ".join(words)))
        labels.append((k, y, 0))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels)


def test_quality_is_the_size_difference(spark):
    docs, labels, rows, known = _labelled(spark, random.Random(1))
    part = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = quality.train(docs.where(part), labels.where(part))
    out = {r["doc_id"]: r for r in quality.score(docs, labels).collect()}
    assert len(out) == len(rows)
    plain = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d)) for d in (model.good, model.bad)]
    for k, text in rows:
        raw, r = text.encode(), out[k]
        good, bad = (sum(len(z.compress(raw[i:i + 1024])) for i in range(0, len(raw), 1024)) for z in plain)
        x = (bad - good) / (len(raw) + 32)
        assert (r["good_bytes"], r["bad_bytes"]) == (good, bad)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-model.slope * x - model.offset)), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (_fold(k, 5) == 0)
    held = [(out[k]["score"] >= .5) == bool(y) for k, y, _ in known if out[k]["held_out"]]
    assert np.mean(held) > .9


def test_quality_does_not_see_held_out_labels(spark):
    docs, labels, rows, known = _labelled(spark, random.Random(2), 120)
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    cols = ["doc_id", "score", "predicted"]
    assert sorted(map(tuple, quality.score(docs, labels).select(cols).collect())) == sorted(
        map(tuple, quality.score(docs, other).select(cols).collect()))


def test_logistic_is_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-3 * x + 1))).astype(float)
    w = rng.random(400) + .5
    a, b = quality.logistic(x, y, w, ridge=0.0)
    p = 1 / (1 + np.exp(-a * x - b))
    assert abs((w * (p - y)).sum()) < 1e-6 and abs((w * (p - y) * x).sum()) < 1e-6


def test_quality_sample_is_bounded():
    raw = bytes(range(256)) * 400
    pieces = quality.spread_pieces(raw)
    assert len(pieces) == quality.MOST_PIECES and all(p in raw for p in pieces)
    assert quality.spread_pieces(b"") == [] and quality.spread_pieces(b"abc") == [b"abc"]


def test_quality_edges(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of(["some text", None, "", "x" * 300000, "some text"], ids=[1, 2, None, 4, 1])
    rows = quality.score(docs, none).collect()
    assert len(rows) == 5 and {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)}
    one = spark.createDataFrame([(1, 1, 0), (4, None, 0), (99, 0, 1), (None, 0, 0), (4, 7, 0)],
                                "doc_id long, quality int, toxic int")
    assert all(0 <= r["score"] <= 1 for r in quality.score(docs, one).collect())
    assert quality.score(docs.limit(0), one).collect() == []
    both, labels, *_ = _labelled(spark, random.Random(3), 150)
    # an id with many different texts teaches once; labels both ways, extra columns
    hot = both.union(spark.range(300).selectExpr("3L as doc_id", "concat('copy ', id) as text")).withColumn("score", F.lit("x"))
    rows = quality.score(hot, labels.union(labels.withColumn("quality", 1 - F.col("quality")).limit(5))).collect()
    assert len(rows) == 450 and all(0 <= r["score"] <= 1 for r in rows)
    empty = quality.score(both.union(spark.createDataFrame([(500, ""), (501, None)], both.schema)), labels).where("doc_id >= 500").collect()
    assert len({r["score"] for r in empty}) == 1


def test_terms_are_counted_as_codes():
    """Split, folded and counted by Arrow and one sort: the terms of a plain expression, and no Counter of strings."""
    import re

    rng = random.Random(5)
    texts = ["".join(rng.choice("aAbZ éß 漢@[`{\x7f\x00\t\n.9") for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    rows = [(rng.choice(["", "l"]), rng.choice("st"), t) for t in texts] + [("l", "s", " . "), ("l", "s", "漢" * 500)]
    n, docs = Counter(), Counter()
    for lang, source, text in rows:
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        n.update((lang, source, t) for t in found)
        docs.update((lang, source, t) for t in set(found))
    batch = pa.RecordBatch.from_pydict(dict(zip(("lang", "source", "text"), map(list, zip(*rows)))))
    for pieces in ([batch], [batch.slice(0, 7), batch.slice(7)], [batch.slice(k, 1) for k in range(len(rows))]):
        got = pa.Table.from_batches(divergence._count(iter(pieces))).to_pylist()
        assert len(got) == len(n)      # texts of several batches are summed
        assert {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in got} == {k: (n[k], docs[k]) for k in n}
    assert not hasattr(divergence, "Counter")
