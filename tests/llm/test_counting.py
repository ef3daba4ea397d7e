"""Partial counts of the language model: what a task holds and hands on."""

from collections import Counter

import numpy as np
import pyarrow as pa

from cartograph.llm import ctw


def _counted(texts, learn):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(learn)], ["text", "learn"])
    return list(ctw._count(iter([batch, batch])))


def _sums(batches):
    n, m = Counter(), Counter()
    for b in batches:
        for kind, key, x, y in zip(*(b.column(c).to_pylist() for c in ("kind", "key", "n", "m"))):
            n[kind, key] += x
            m[kind, key] += y
    return n, m


def test_partial_counts_leave_a_task_in_small_batches(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)) for _ in range(20)] + [None, ""]
    learn = [i % 3 != 0 for i in range(len(texts))]
    whole = _counted(texts, learn)
    monkeypatch.setattr(ctw, "ROWS_OUT", 50)
    monkeypatch.setattr(ctw, "FRESH", 100)
    monkeypatch.setattr(ctw, "FLUSH", 400)
    ctw._scorers["earlier run"] = object()
    pieces = _counted(texts, learn)
    assert max(b.num_rows for b in pieces) <= 50 < max(b.num_rows for b in whole)
    assert _sums(pieces) == _sums(whole)
    assert not ctw._scorers


def test_a_tally_merges_before_much_is_held(monkeypatch):
    monkeypatch.setattr(ctw, "FRESH", 10)
    tally, want, most = ctw.Tally(), Counter(), 0
    for k in range(40):
        keys = np.arange(k, k + 5, dtype=np.uint64)
        want.update(keys.tolist())
        tally.add(keys)
        most = max(most, tally.held - tally.merged)
    keys, counts = tally.merge()
    assert most <= 10 and dict(zip(keys.tolist(), counts.tolist())) == want
