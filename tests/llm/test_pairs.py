"""Line dedup, decontamination, n-gram join, packing: edges and brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401

from cartograph.llm import common as C
from cartograph.llm import decontaminate, line_align, line_dedup, ngram_join, packing
from cartograph.llm import text as X

EDGES = [None, "", " \n\t ", "one", "two words", "two words", "a b c d e f", "é ß 漢字 " * 3]


def _words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def _corpus(seed=3):
    """Originals, exact and near copies, shared passages, a common line, one long text."""
    rng = random.Random(seed)
    out = list(EDGES)
    passage = _words(rng, 60, 10_000) + "."
    common = "all of them have this very line."
    for k in range(25):
        base = _words(rng, rng.randrange(5, 120), 3000).split()
        out.append(" ".join(base))
        if k % 3 == 0:
            near = list(base)
            near[rng.randrange(len(near))] = "changed"
            out += [" ".join(base).upper(), " ".join(near)]
        if k % 4 == 0:
            out.append(_words(rng, 30) + " " + passage + " " + _words(rng, 30))
        if k % 2 == 0:
            out.append(common + "\n" + _words(rng, 15))
    out.append(_words(rng, 20_000))
    return out


def _join_by_hand(texts, ids, size, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    link = {i: set() for i in range(len(ids))}
    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                link[a].add(b), link[b].add(a)
    group = list(ids)
    changed = True
    while changed:
        changed = False
        for a in link:
            low = min([group[a]] + [group[b] for b in link[a]])
            if low < group[a]:
                group[a], changed = low, True
    return {ids[k]: (len(sets[k]), group[k], len(link[k])) for k in range(len(ids))}


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (2, 50)])
def test_join_equals_brute_force(docs_of, size, percent):
    texts = _corpus()
    ids = random.Random(1).sample(range(1000), len(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links)
           for r in ngram_join.join(docs_of(texts, ids), size, percent).collect()}
    assert got == _join_by_hand(texts, ids, size, percent)


def test_join_blocks_give_the_same(docs_of, monkeypatch):
    texts = [f"a b c d e f g h i j k l m n o p q r s t u v w x y {k % 7} {k}" for k in range(40)]
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    monkeypatch.setattr(ngram_join, "HOT_CLASSES", 2)
    monkeypatch.setattr(ngram_join, "BOUND_CLASSES", 3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.join(docs_of(texts), 3, 80).collect()}
    assert got == _join_by_hand(texts, list(range(40)), 3, 80)


def test_join_ids_and_empty(docs_of):
    got = ngram_join.join(docs_of(["a b c", "a b c", "a b c", None], ids=[5, 5, None, 7])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id, r.n_shingles) for r in got) == [
        (False, 5, 5, 1), (False, 5, 5, 1), (False, 7, 7, 0), (True, 0, None, 1)]
    assert ngram_join.join(docs_of([])).count() == 0
    kept = ngram_join.one_per_group(docs_of(["a b c", "a b c", "x"], ids=[2, 1, None]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"] and len(kept.columns) == 8


@pytest.mark.parametrize("order", [(0, 1, 2), (1, 0, 2), (2, 0, 1), (0, 2, 1)])
def test_join_row_without_id_leaves_its_equals_their_links(docs_of, order):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(text, None), (text, 4), (text + " more", 9)]
    docs = docs_of([rows[k][0] for k in order], [rows[k][1] for k in order]).coalesce(1)
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.join(docs).collect()}
    assert got == {None: (None, 0), 4: (4, 1), 9: (4, 1)}
    assert sorted(str(r.doc_id) for r in ngram_join.one_per_group(docs).collect()) == ["4", "None"]


def test_join_id_with_two_texts_has_the_links_of_both(docs_of):
    one, two = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    # a small chain between the two texts, so that they fall into one candidate component
    both = " ".join(one.split()[:30] + two.split()[:30])
    rows = [(one, 5), (two, 5), (one + " more", 7), (two + " more", 9), (two, 3), (two, 3), (None, 5), (both, 11)]
    for r in (rows, rows[::-1]):
        got = {(x.doc_id, x.component_id, x.n_links)
               for x in ngram_join.join(docs_of([t for t, _ in r], [i for _, i in r]), 3, 90).collect()}
        # 5 with 7, and with 3 and 9; 3 with 5 and 9
        assert got == {(5, 3, 3), (7, 3, 1), (9, 3, 2), (3, 3, 2), (11, 11, 0)}
    kept = ngram_join.one_per_group(docs_of([t for t, _ in rows], [i for _, i in rows]))
    assert {r.doc_id for r in kept.collect()} == {3, 11}


def test_candidates_equal_brute_force(spark):
    """Every pair that links is a candidate, by block pairs of hot n-grams too."""
    rng = random.Random(8)
    sets = []
    for _ in range(60):
        base = [rng.randrange(40) for _ in range(rng.choice([1, 4, 12, 30]))]
        sets += [np.unique(np.array([rng.randrange(40) if rng.random() < .06 else x for x in base], np.uint64) << np.uint64(50))
                 for _ in range(4)]
    table = np.zeros(1 << ngram_join.COUNTER_BITS, np.uint8)
    for percent in (60, 90):
        linked = {(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i]) and len(sets[j])
                  and 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))}
        for cool in (10 ** 6, 0):  # all n-grams rare, all hot
            rows = []
            for k, s in enumerate(sets):
                keys, _ = ngram_join._rare_end(s, table, percent)
                rows.append((k, len(s), k, k, [int(x) for x in keys.astype(np.int64)], min(cool, len(keys)),
                             ngram_join.histogram(s).tobytes()))
            filed = spark.createDataFrame(rows, "doc_id long, n long, s1 long, s2 long, keys array<long>, cool int, buckets binary")
            ties = ngram_join.candidates(filed, percent, 7)
            hubs = {}
            for r in ties.collect():
                hubs.setdefault(r.s1, set()).add(r.hub)
            assert len(linked) > 100 and all(hubs[i] & hubs[j] for i, j in linked)
            groups = {r.s1: r.comp for r in ngram_join.likely_groups(filed, ties, percent, C.Scratch(spark, "t")).collect()}
            assert all(groups[i] == groups[j] for i, j in linked)


def test_histograms_bound_the_overlap():
    rng = np.random.default_rng(4)
    sets = []
    for n in (1, 3, 100, 129, 140, 1000, 1030, 5000):
        base = rng.integers(0, 1 << 62, n).astype(np.uint64)
        sets += [np.unique(np.where(rng.random(n) < p, rng.integers(0, 1 << 62, n).astype(np.uint64), base)) for p in (0, .02, .1, .5)]
    sets.sort(key=len)
    n = np.array(list(map(len, sets)))
    got = {(i, int(j)) for i, js in ngram_join.within_bound(n, [ngram_join.histogram(s) for s in sets], np.zeros(len(n)), 80)
           for j in js}
    linked = {(i, j) for j in range(len(sets)) for i in range(j)
              if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert linked <= got and len(linked) > 15 and len(got) < 3 * len(linked)


def test_forest():
    f = ngram_join.Forest(6)
    f.merge(4, np.array([5, 2]))
    f.merge(1, np.array([3]))
    f.merge(3, np.array([5]))
    assert f.roots(np.arange(6)).tolist() == [0, 1, 1, 1, 1, 1]


def test_partial_overlaps_are_summed_over_fragments(docs_of, monkeypatch):
    """On texts of which every pair has n-grams in several fragments, the sum decides."""
    rng = random.Random(12)
    base = _words(rng, 200, 9999).split()
    texts = []
    for k in range(30):
        w = list(base)
        for _ in range(k):
            w[rng.randrange(len(w))] = f"other{k}"
        texts.append(" ".join(w))
    table = np.zeros(1 << ngram_join.COUNTER_BITS, np.uint8)
    grams = next(X.word_chunks(__import__("pyarrow").array([texts[0]])))[2].hash
    parts = ngram_join.fragment_of(X.shingles(grams, 3), table, 9)
    assert len(set(parts.tolist())) == 8  # the last fragment is for frequent ones
    table[:] = 9
    assert set(ngram_join.fragment_of(X.shingles(grams, 3), table, 9).tolist()) == {8}
    results = []
    for fragments in (1, 9):
        monkeypatch.setattr(ngram_join, "FRAGMENTS", fragments)
        results.append(sorted(map(tuple, ngram_join.join(docs_of(texts), 3, 80).collect())))
    assert results[0] == results[1] and len({r[2] for r in results[0]}) > 1
    assert any(r[3] not in (0, len(texts) - 1) for r in results[0])


def test_segments_too_far_apart_are_dropped():
    sets = [np.arange(0, 30, dtype=np.uint64), np.arange(0, 29, dtype=np.uint64), np.arange(10, 40, dtype=np.uint64)]
    n = np.array([100, 99, 100])
    got = [(i, j.tolist(), o.tolist()) for i, j, o in ngram_join.count_segments(sets, n, np.array([0]), np.array([1, 2]), 90)]
    assert got == [(0, [0], [29])]  # 0 and 2 share 20 here, but differ in 20 of at most 10


def _lines(t):
    raw = np.frombuffer((t or "").encode(), np.uint8)
    w = X.words(raw, np.array([0, len(raw)]))
    first, _ = line_dedup.lines(w)
    stop = [*first, len(w.hash)]
    return [tuple(w.hash[a:b].tolist()) for a, b in zip(stop, stop[1:])]


def test_line_dedup_equals_brute_force(docs_of):
    texts = _corpus(4)
    got = {r.doc_id: r for r in line_dedup.dedup(docs_of(texts)).collect()}
    seen, want = set(), {}
    for i, t in enumerate(texts):
        lines, gone, own, keys = _lines(t), set(), Counter(), []
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += len(lines[b])
                if n >= line_dedup.MIN_WORDS:
                    run = sum(lines[a:b + 1], ())
                    own[run] += 1
                    keys.append((run, own[run]))
                    if keys[-1] in seen:
                        gone |= set(range(a, b + 1))
                    break
        seen |= set(keys)
        want[i] = len(gone)
    assert {i: r.removed_lines for i, r in got.items()} == want
    assert sum(want.values()) > 10
    assert all(got[i].text == t for i, t in enumerate(texts) if not want[i])


def test_line_dedup_catches_a_passage_and_leaves_the_rest(docs_of):
    rng = random.Random(9)
    passage = ". ".join(_words(rng, 12, 9999) for _ in range(6)) + "."
    one, two = _words(rng, 40, 9999), _words(rng, 40, 9999)
    got = {r.doc_id: r.text for r in line_dedup.dedup(
        docs_of([f"{one} {passage} tail", f"{two} {passage}\nend", "short line\nshort line"], ids=[3, 8, 9])).collect()}
    assert got[3] == f"{one} {passage} tail" and got[9] == "short line\nshort line"
    left = got[8].split()
    assert left[:30] == two.split()[:30] and left[-1] == "end" and len(left) < 60


def test_patience_chain():
    assert line_dedup.patience([0, 1, 2, 3], [5, 1, 2, 9]) == [1, 2, 3]
    assert line_dedup.patience([], []) == []
    moved = line_dedup.aligned_blocks([0, 1, 5, 6], [0, 1, 5, 6], [7, 8, 0, 1])
    assert sorted(moved) == [(0, 1), (5, 6)]


def test_line_dedup_edges(docs_of):
    long = " ".join(f"w{k}" for k in range(80))
    out = line_dedup.drop_repeated_lines(docs_of([long, long, None, ""], ids=[1, 2, 3, None]))
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "None"] and len(out.columns) == 8
    assert line_dedup.dedup(docs_of([])).count() == 0
    same = line_dedup.dedup(docs_of([long, long], ids=[4, 4])).collect()
    assert all(r.text == long and r.removed_lines == 0 for r in same)


def _bench(spark, texts):
    return spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "item_id long, text string, similarity string")


def test_decontamination_equals_brute_force(spark, docs_of):
    rng = random.Random(5)
    items = [_words(rng, n, 200) for n in (3, 5, 9, 15, 30, 31, 60)] + [None, "", "single"]
    texts = list(EDGES) + ["before single after", items[1], items[4] + " tail"]
    for k in range(40):
        w = items[rng.randrange(7)].split()
        if k % 2:
            w[rng.randrange(len(w))] = "other"
        if k % 5 == 0:
            w = w[: len(w) - 1]
        texts.append(_words(rng, 20, 200) + " " + " ".join(w).upper() + " " + _words(rng, 20, 200))
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find(docs_of(texts), _bench(spark, items)).collect()}
    want = {}
    cut = lambda w, k: [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        for j, item in enumerate(items):
            v = (item or "").lower().split()
            if not v or not w:
                continue
            k, best = min(5, len(v)), 0
            for s in range(max(1, len(w) - len(v) + 1)):
                a, b = Counter(cut(w[s:s + len(v)], k)), Counter(cut(v, k))
                if a:
                    best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= 0.8:
                want[i, j] = best
    assert len(want) > 20 and {k: pytest.approx(v) for k, v in want.items()} == got


def test_decontamination_parts_and_edges(spark, docs_of, monkeypatch):
    rng = random.Random(6)
    items = [_words(rng, 20, 5000) for _ in range(12)]
    docs = docs_of([f"x {t} y" for t in items] + ["clean text of no item"])
    whole = sorted(map(tuple, decontaminate.find(docs, _bench(spark, items)).collect()))
    monkeypatch.setattr(decontaminate, "PART_BYTES", 300)
    assert sorted(map(tuple, decontaminate.find(docs, _bench(spark, items)).collect())) == whole and len(whole) == 12
    assert [r.doc_id for r in decontaminate.clean(docs, _bench(spark, items)).collect()] == [12]
    assert decontaminate.find(docs, _bench(spark, [])).count() == 0
    assert decontaminate.find(docs_of([]), _bench(spark, items)).count() == 0


def test_fingerprints_near_for_similar():
    rng = np.random.default_rng(1)
    far = []
    for _ in range(300):
        s = rng.integers(0, 1 << 63, 34).astype(np.uint64)
        t = s.copy()
        t[:4] = rng.integers(0, 1 << 63, 4)
        a, b = (decontaminate.fingerprints(x, np.array([0]), 34) for x in (s, t))
        far.append(int(np.bitwise_count(a ^ b)[0]))
    assert max(far) <= 24


def test_packing_is_best_fit():
    rng = random.Random(2)
    for _ in range(20):
        items = sorted([(rng.randint(1, 60), rng.choice(["a", "a", "b", "c", None]), rng.choice([None, 1, 2, 3]))
                        for _ in range(150)], key=lambda x: -x[0])
        bins, want = [], []
        for n, s, c in items:
            fit = [k for k, (room, ss, cc) in enumerate(bins) if room >= n and (s is None or s not in ss)
                   and (c is None or c not in cc)]
            k = min(fit, key=lambda k: (bins[k][0], k)) if fit else len(bins)
            if k == len(bins):
                bins.append([64, set(), set()])
            want.append((k, 64 - bins[k][0]))
            bins[k][0] -= n
            bins[k][1].add(s), bins[k][2].add(c)
        assert packing.pack_shard(items, 64) == want


def test_packing_rows(docs_of):
    rng = random.Random(7)
    texts = list(EDGES) + [_words(rng, rng.randrange(1, 400)) for _ in range(200)]
    sources = [rng.choice(["hot", "hot", "a", "b", None]) for _ in texts]
    ids = [None] + list(range(1, len(texts)))
    rows = packing.pack(docs_of(texts, ids, sources=sources), capacity=100, shard_rows=50).collect()
    want = {i: len((t or "").split()) + 1 for i, t in zip(ids, texts)}
    got, bins, of = Counter(), {}, dict(zip(ids, sources))
    for r in rows:
        got[r.doc_id] += r.n_tokens
        bins.setdefault(r.bin_id, []).append(r)
    assert got == want
    for b in bins.values():
        b.sort(key=lambda r: r.bin_offset)
        assert b[0].bin_offset == 0 and all(x.bin_offset + x.n_tokens == y.bin_offset for x, y in zip(b, b[1:]))
        assert b[-1].bin_offset + b[-1].n_tokens <= 100
        s = [of[r.doc_id] for r in b if of[r.doc_id] is not None]
        assert len(s) == len(set(s))
    assert packing.pack(docs_of([])).count() == 0


def _words_left(texts, ids, size):
    """Words of each text that lie in no run of ``size`` words of a text of smaller id."""
    cut = [(t or "").lower().split() for t in texts]
    runs = lambda w: [tuple(w[a:a + size]) for a in range(max(1, len(w) - size + 1))] if w else []
    first = {}
    for i, w in zip(ids, cut):
        for run in runs(w):
            first[run] = min(i, first.get(run, i))
    out = {}
    for i, t, w in zip(ids, texts, cut):
        gone = {a + k for a, run in enumerate(runs(w)) if first[run] < i for k in range(len(run))}
        out[i] = [x for k, x in enumerate((t or "").split()) if k not in gone]
    return out


def test_line_dedup_by_words_equals_brute_force(docs_of):
    rng = random.Random(12)
    passages = [_words(rng, n, 9999) for n in (24, 25, 26, 40, 52, 80, 120)]
    twice = _words(rng, 30, 9999)
    texts = _corpus(4) + [twice, f"{_words(rng, 9)} {twice} {_words(rng, 9)}\n{twice} {twice}", "la " * 90, "la " * 200]
    for k in range(28):
        texts.append(f"{_words(rng, 20, 9999)} {passages[k % 7]} {_words(rng, 20, 9999)} {passages[k % 5].upper()}")
    ids = random.Random(2).sample(range(1000), len(texts))
    want = _words_left(texts, ids, 25)
    got = {r.doc_id: r for r in line_dedup.dedup(docs_of(texts, ids), 25, whole_lines=False).collect()}
    assert {i: (r.text or "").split() for i, r in got.items()} == want
    assert all((r.removed_lines > 0) == (len(want[i]) < len((t or "").split()))
               for (i, t) in zip(ids, texts) for r in [got[i]])
    assert all(got[i].text == t for i, t in zip(ids, texts) if not got[i].removed_lines)


def test_line_dedup_query_cuts_every_occurrence(spark, docs_of, tmp_path):
    from cartograph.llm import queries

    rng = random.Random(21)
    passage = ". ".join(_words(rng, 15, 9999) for _ in range(3)) + "."
    docs_of([passage, f"start.\n{passage}\nmiddle.\n{passage}\nend."]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.text for r in queries.op1_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: passage, 1: "start.\nmiddle.\nend."}


# ---- line dedup by alignment ----------------------------------------------------------

def test_alignment_decides():
    """Runs out of order are in no block of the first alignment: a union of all shared runs would have them."""
    # A B C there, C A B here, 25 words each
    got = line_align.aligned([0, 30, 60], [60, 0, 30], [25, 25, 25])
    assert got == [(30, 54, 0, False), (60, 84, 30, False), (0, 24, 60, True)]
    few = np.arange(100, dtype=np.uint64)
    beside = [dict(first=a, last=b, again=again, left=b"", right=b"") for a, b, _, again in got]
    assert line_align.grown(few, beside) == [30, 54, 60, 84]  # the union: 0 to 24 too
    # a passage that has moved counts
    longer = line_align.aligned([0, 12, 40, 65], [90, 102, 0, 25], [25] * 4)
    assert longer == [(40, 89, 0, False), (0, 36, 90, True)] or longer == [(0, 36, 90, False), (40, 89, 0, True)]
    beside = [dict(first=a, last=b, again=again, left=b"", right=b"") for a, b, _, again in longer]
    assert line_align.grown(few, beside) == [0, 36, 40, 89]


def test_alignment_of_pairs_in_order_equals_patience():
    rng = random.Random(4)
    rows, want = [], []
    for owner in range(40):
        at, k = sorted(rng.sample(range(400), 12)), rng.choice([0, 100])
        other = sorted(rng.sample(range(400), 12)) if owner % 3 else [a + k for a in at]
        if owner % 5 == 0:
            rng.shuffle(other)
        rows += [(9, 1, owner, 2, a, o, 25) for a, o in zip(at, other)]
        want += [(9, 1, owner, 2, *b) for b in line_align.aligned(at, other, [25] * 12)]
    import pyarrow as pa

    names = ["doc_id", "print", "owner", "oprint", "at", "other", "words"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + 7])], names) for i in range(0, len(rows), 7)]
    got = [r for b in line_align._align(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert sorted(got) == sorted(want)


def test_every_passage_has_a_line_within():
    rng = random.Random(6)
    for n in (line_align.PASSAGE, 40, 60):
        for _ in range(60):
            passage = _words(rng, n, 30 if _ % 2 else 9999)
            found = []
            for _ in range(2):
                before, after = _words(rng, rng.randrange(50), 9999), _words(rng, rng.randrange(50), 9999)
                raw = np.frombuffer(f"{before} {passage} {after}".encode(), np.uint8)
                w = X.words(raw, np.array([0, len(raw)]))
                row, at, h = line_align.lines(w)
                a = len(before.split())
                runs = set()
                for p in at:
                    for s in (p - (line_align.BLOCK - line_align.LINE), p):
                        if a <= s and s + line_align.BLOCK <= a + n:
                            runs.add(s - a)
                found.append(runs)
            assert found[0] & found[1]


def test_aligned_dedup_equals_brute_force(docs_of):
    """Texts of words of their own around passages: what lies in a passage of an earlier text goes, to the word."""
    rng = random.Random(15)
    own = iter(range(10 ** 6))
    fresh = lambda n: " ".join(f"u{next(own)}" for _ in range(n))
    passages = [fresh(n) for n in (37, 40, 52, 80, 120)]
    texts = [None, "", passages[1], "la " * 90, fresh(20), fresh(30)]
    texts += [texts[4], texts[5].upper(), texts[4] + " more", "la " * 300]
    for k in range(36):
        parts = rng.sample(passages, rng.randrange(4))
        text = fresh(rng.randrange(60))
        for p in parts + parts[:k % 2]:
            text += rng.choice([" ", "\n", ". "]) + p + rng.choice([" ", "\n"]) + fresh(rng.randrange(1, 60))
        texts.append(text)
    ids = rng.sample(range(1000), len(texts))
    want = _words_left(texts, ids, line_align.PASSAGE)
    rows = line_align.dedup(docs_of(texts, ids)).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) and {i: (r.text or "").split() for i, r in got.items()} == want
    assert all(got[i].text == t for i, t in zip(ids, texts) if not got[i].removed_lines)
    assert sum(r.removed_lines > 0 for r in rows) > 20


def test_aligned_dedup_edges(docs_of, monkeypatch):
    monkeypatch.setattr(line_align, "HOT_ROWS", 2)  # frequent runs in shares
    rng = random.Random(3)
    passage = _words(rng, 60, 99999)
    texts = [f"{_words(rng, 30, 99999)} {passage} {_words(rng, 30, 99999)}" for _ in range(12)]
    out = line_align.drop_repeated(docs_of(texts + [passage, None, "x"], ids=[*range(12), 50, 51, None])).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted([*map(str, range(12)), "51", "None"]) and len(out[0]) == 8
    by = {r.doc_id: r for r in out}
    assert by[0].text == texts[0] and all(len(by[k].text.split()) == 60 and by[k].n_chars == len(by[k].text) for k in range(1, 12))
    same = line_align.dedup(docs_of([passage, passage, passage], ids=[4, 4, 9])).collect()
    assert sorted((r.doc_id, r.text) for r in same) == [(4, passage), (4, passage), (9, "")]
    assert line_align.dedup(docs_of([])).collect() == []
    long = " ".join(f"w{k}" for k in range(150_000))
    rows = line_align.dedup(docs_of([long, "start " + long + " end"])).orderBy("doc_id").collect()
    assert rows[0].text == long and rows[1].text.split() == ["start", "end"]
