"""Language model, language ID, toxicity, neighbours, pages and token files."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs_of  # noqa: F401

from cartograph.llm import ann, common, ctw, html_extract, langid, linear, toxicity, wavelet
from cartograph.llm import text as X

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _fold(i, n):
    return zlib.crc32(str(i).encode()) % n


# ---- words and grams ------------------------------------------------------------

def test_words_match_bytes_split():
    texts = [None, "", "A b\tC\x0bd\x0ce\r\nf", " x ", "é É", "0" * 5000 + " q", "\n"]
    got = []
    for a, b, w in X.word_chunks(pa.array(texts)):
        for r in range(b - a):
            got.append([w.data[s:e].tobytes() for s, e in zip(w.start, w.end)][w.first[r]:w.first[r + 1]])
    assert got == [(t or "").encode().split() for t in texts]
    one = [w.hash for _, _, w in X.word_chunks(pa.array(["Foo foo FOO fo", "É é"]))][0]
    assert one[0] == one[1] == one[2] != one[3] and one[4] != one[5]


def test_chunks_change_nothing(monkeypatch):
    texts = pa.array([f"some words {k} and more" for k in range(50)])
    whole = np.concatenate([w.hash for _, _, w in X.word_chunks(texts)])
    monkeypatch.setattr(X.chunks, "__defaults__", (40,))
    assert (np.concatenate([w.hash for _, _, w in X.word_chunks(texts)]) == whole).all()


def test_distinct_and_slots():
    d = X.Distinct(6)
    for s in ([3, 1, 3, 2], [3, 3], [], [1]):
        assert sorted(d(np.array(s, np.int32))) == sorted(set(s))
    rows = [np.concatenate(s) for _, _, s in X.row_slots(pa.array(["ab", "AB", "", None, "a"]), (1, 2), 10)]
    assert (rows[0] == rows[1]).all() and len(rows[0]) == 3 and len(rows[2]) == len(rows[3]) == 0 and len(rows[4]) == 1


# ---- context-tree weighting -------------------------------------------------------

def _kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - 2 * math.lgamma(.5) - math.lgamma(a + b + 1)


def _tree_by_hand(texts):
    n = Counter()
    for t in texts:
        h = b"\xff" * ctw.DEPTH + t.encode() + b"\xff"
        for p in range(ctw.DEPTH, len(h)):
            for j in range(8):
                bit = h[p] >> (7 - j) & 1
                for d in range(ctw.DEPTH + 1):
                    n[d, h[p - d:p], (1 << j) | h[p] >> (8 - j), bit] += 1
    nodes = {k[:3] for k in n}
    weighted, odds = {}, {}
    for d in range(ctw.DEPTH, -1, -1):
        for node in nodes:
            if node[0] == d:
                own = _kt(n[(*node, 0)], n[(*node, 1)])
                if d == ctw.DEPTH:
                    weighted[node] = own
                else:
                    below = sum(w for c, w in weighted.items() if c[0] == d + 1 and c[2] == node[2]
                                and c[1][1:] == node[1])
                    odds[node] = own - below
                    weighted[node] = math.log(.5) + np.logaddexp(own, below)
    return n, odds


def _score_by_hand(n, odds, t):
    h, total = b"\xff" * ctw.DEPTH + t.encode() + b"\xff", 0.0
    for p in range(ctw.DEPTH, len(h)):
        for j in range(8):
            bit, prefix = h[p] >> (7 - j) & 1, (1 << j) | h[p] >> (8 - j)
            q = None
            for d in range(ctw.DEPTH, -1, -1):
                node = (d, h[p - d:p], prefix)
                a, b = n[(*node, 0)], n[(*node, 1)]
                if a + b:
                    own = ((b if bit else a) + .5) / (a + b + 1)
                    w = 1 if q is None else 1 / (1 + math.exp(-odds[node]))
                    q = own if q is None else w * own + (1 - w) * q
            total += math.log10(.5 if q is None else q)
    return total


def test_ctw_equals_the_tree_by_hand(docs_of):
    texts = ["abracadabra", "abra cadabra abra", "", None, "Abra", "über", "zebra 12"] * 2
    got = {r.doc_id: r for r in ctw.score(docs_of(texts), F.col("doc_id") < 6).collect()}
    n, odds = _tree_by_hand([t or "" for t in texts[:6]])
    for i, t in enumerate(texts):
        assert got[i].score == pytest.approx(_score_by_hand(n, odds, t or ""), rel=1e-9)
    c = Counter(w for t in texts[:6] for w in (t or "").lower().split())
    total, kinds = sum(c.values()) + 6, len(c) + 1
    for i, t in enumerate(texts):
        w = (t or "").replace("Ü", "ü").lower().split()
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w) + 1, sum(x in c for x in w) + 1, total)
        want = sum(math.log10((k + 1) / (total + kinds + 1)) for k in [c[x] for x in w] + [6])
        assert got[i].base_score == pytest.approx(want)


def test_ctw_is_a_distribution_whatever_is_hot(docs_of, monkeypatch):
    docs = docs_of(["the cat sat on the mat", "the dog sat", "a dog and a cat"] * 3)
    scratch = common.Scratch(docs.sparkSession, "ctw-test")
    want = {r.gram: r.lp for r in ctw.train(docs, F.lit(True), scratch)[2].collect()}
    counts = docs.select("text", F.lit(True).alias("learn")).mapInArrow(ctw._count, ctw.COUNTS).where(f"kind = {ctw.GRAM}")
    asked = [(int.from_bytes(c, "big") << 8 | b, 1, 0)
             for c in (b"\xff\xff\xff th", b"xxxxx", b" a do") for b in range(256)]
    asked = [(g & (1 << 48) - 1, n, m) for g, n, m in asked]
    both = (counts.select(F.col("key").alias("gram"), "n", "m")
            .union(docs.sparkSession.createDataFrame(asked, "gram long, n long, m long"))
            .groupBy("gram").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    got = {r.gram: r.lp for r in ctw.values(both, scratch).collect()}
    for k in range(3):
        assert sum(10 ** got[g] for g, _, _ in asked[256 * k:256 * k + 256]) == pytest.approx(1)
    assert all(got[g] == pytest.approx(v) for g, v in want.items())
    few, words, _ = ctw.train(docs, F.lit(True), scratch, hot_words=2, hot_grams=10)
    assert len(few.hot) <= 2 and len(few.gram) <= 10 and words.count() == 8
    every = {r.doc_id: r.score for r in ctw.score(docs, F.lit(True)).collect()}
    monkeypatch.setattr(ctw.train, "__defaults__", (2, 10))
    monkeypatch.setattr(ctw, "BLOCK", 1)
    cold = {r.doc_id: r.score for r in ctw.score(docs, F.lit(True)).collect()}
    assert cold == pytest.approx(every)
    scratch.drop()


def test_ctw_long_and_repeated_texts(docs_of):
    rng = random.Random(9)
    long = " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(60_000))
    texts = [long, "alpha beta", "alpha beta", "", None, "omega"]
    got = sorted(((r.doc_id, r.n_tokens, r.score) for r in
                  ctw.score(docs_of(texts, ids=[1, 2, 2, 3, 4, None]), F.coalesce(F.col("doc_id"), F.lit(0)) < 4).collect()),
                 key=lambda x: (x[0] is None, x[0]))
    assert [x[:2] for x in got] == [(1, 60_001), (2, 3), (2, 3), (3, 1), (4, 1), (None, 2)]
    assert got[1][2] == got[2][2] and got[3][2] == got[4][2]
    assert -got[0][2] / math.log10(2) / len(long) < 0.5     # two bits a word of about six bytes


def test_ctw_edges(docs_of):
    got = ctw.score(docs_of(["ab", None], ids=[None, 1]), F.lit(False)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0), (2, 0, 0, 0)]
    assert sorted(r.score for r in got) == pytest.approx([-24 * math.log10(2), -8 * math.log10(2)])
    assert ctw.score(docs_of([]), F.lit(True)).count() == 0


# ---- classifiers ----------------------------------------------------------------

def test_ftrl_learns_and_is_sparse():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 400)
    rows = [(np.array([k, 3 + rng.integers(0, 40)]), np.ones(2)) for k in y]
    w, b = linear.fit(rows, y, 3, 50, l1=0.5)
    assert np.mean([np.argmax(v @ w[i] + b) for i, v in rows] == y) > 0.99 and (w == 0).mean() > 0.3
    logits = 8 * np.eye(3)[y]
    flip = y.copy()
    flip[::5] = (flip[::5] + 1) % 3
    t = linear.temperature(logits, flip)
    assert t > 2 and linear.softmax(logits / t).max(axis=1).mean() == pytest.approx(0.8, abs=0.05)


def _two_languages(n):
    rng = random.Random(4)
    a, b = "the and of with that".split(), "der und von mit dass".split()
    return [(" ".join(rng.choice(a if k % 2 else b) for _ in range(rng.randrange(3, 40))), "en" if k % 2 else "de")
            for k in range(n)]


def test_language_id_held_out(docs_of):
    rows = _two_languages(300)
    extra = [(None, "en"), ("", "de"), ("12 34 !", "en"), ("the and of", None), ("漢字", "en")]
    texts, langs = zip(*(rows + extra))
    ids = [*range(300), *range(1000, 1004), None]
    got = langid.identify(docs_of(list(texts), ids, list(langs))).collect()
    by = {r.doc_id: r for r in got}
    assert all(by[k].held_out == (_fold(k, 5) == 0) for k in range(300))
    held = [by[k].lang_pred == langs[k] for k in range(300) if by[k].held_out]
    assert np.mean(held) > 0.98 and all(0 <= r.score <= 1 for r in got)
    assert [by[1000 + k].lang_pred for k in range(4)] == ["und", "und", "und", "en"]
    assert by[None].held_out is None and by[None].lang_pred in ("en", "de")
    kept = langid.keep_identified(docs_of(list(texts), ids, list(langs)))
    assert len(kept.columns) == 8 and kept.columns[5] == "score" and kept.where("score = 9").count() >= 300


def test_language_id_without_labels(docs_of):
    assert {(r.lang_pred, r.score) for r in langid.identify(docs_of(["abc", None], langs=[None, None])).collect()} == {("und", 0.0)}
    assert langid.identify(docs_of([])).count() == 0


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_toxicity_held_out(spark, docs_of):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(60)]
    texts, toxic = [], []
    for k in range(400):
        w = [rng.choice(words) for _ in range(rng.randrange(3, 60))]
        toxic.append(int(k % 4 == 0))
        if toxic[-1]:
            w[rng.randrange(len(w))] = rng.choice(["Idiot", "STUPID", "scum"])
        texts.append(" ".join(w))
    docs = docs_of(texts + [None, ""], ids=[*range(400), 900, None])
    flipped = [(k, 1, t if _fold(k, 5) else 1 - t, "x") for k, t in enumerate(toxic)]  # must not be looked at
    got = {r.doc_id: r for r in toxicity.score(docs, _labels(spark, flipped + [(None, 1, 1, "x"), (5, 1, None, "x"),
                                                                             (7777, 0, 1, "x")])).collect()}
    assert len(got) == 402 and got[None].held_out is None
    right = [(got[k].predicted == toxic[k]) for k in range(400) if got[k].held_out]
    assert np.mean(right) > 0.95 and got[900].predicted == 0
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_toxicity_without_both_labels(spark, docs_of):
    got = toxicity.score(docs_of(["a", "b"]), _labels(spark, [(0, 1, 0, "x"), (1, 1, 0, "x")])).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.5, 1)}
    assert toxicity.score(docs_of([]), _labels(spark, [])).count() == 0


def test_sample_is_bounded(spark, docs_of):
    rows = docs_of([f"t{k}" for k in range(3000)], langs=["a" if k % 3 else "b" for k in range(3000)])
    ids = common.smallest_hashes(rows, {"a": 2000, "b": 1000}, "lang", 50)
    per = Counter(1 if r.doc_id % 3 else 0 for r in ids.collect())
    assert per == {1: 50, 0: 50}


# ---- neighbours -------------------------------------------------------------------

def test_neighbours_recall_and_exactness(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 12)).astype(np.float32)
    x[700:1200] = x[3] + rng.normal(size=(500, 12)).astype(np.float32) * 0.01  # a hot place
    x[20:40] = x[10]                                                            # ties
    rows = [(int(k), [float(c) for c in v], 0) for k, v in enumerate(x)]
    odd = [(5000, None, 0), (5100, [], 0), (5200, [0.0] * 12, 0), (5300, [float("nan")] * 12, 0),
           (5400, [1.0, None] + [0.0] * 10, 0), (5500, [1.0] * 5, 0), (None, [1.0] * 12, 0), rows[9]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int")
    monkeypatch.setattr(ann, "BLOCK_ROWS", 200)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 100 == 0, parts=8).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert set(got) == set(range(0, 1500, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(1500), d))[:10]
        hits += len({v for _, _, v in found} & set(want.tolist()))
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert all(s == pytest.approx(d[v], rel=1e-12) for _, s, v in found)
        assert sorted(found) == [(k + 1, s, v) for k, (s, v) in enumerate(sorted((s, v) for _, s, v in found))]
    assert hits >= 0.9 * 150


def test_neighbours_small(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ann.search(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, pytest.approx(2 ** .5))]
    assert ann.search(df.where("vec_id < 0"), F.lit(True)).count() == 0
    assert ann.search(df.where("vec_id = 1"), F.lit(True)).count() == 0


def test_partition_is_balanced():
    x = np.random.default_rng(1).normal(size=(800, 8))
    graph = ann.neighbours(x, 5)
    part = ann.balanced_partition(x, graph, 8)
    assert np.bincount(part).max() <= 105 and (part[graph] == part[:, None]).mean() > 0.3


# ---- pages ----------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><div class="cookie-notice">We use cookies</div>
<header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=a>Menu</a></li></ul></nav>
<div id="sidebar"><p>About this very long sidebar text that goes on and on with many words in it to fool.</p></div>
<div class="content"><h2>Title &amp; more</h2><p>First &eacute; para with   many words and
 some more words here to be long enough.</p><p>Short.</p><form><input><label>Your mail</label></form>
<p>Another rather long paragraph, with <a href=x>a link</a> and <em>emphasis</em>&nbsp;too.<p>Open one
<ul><li>item one</li><li>item two</li></ul><script>var t="</p>"; if(a<b){}</script></div>
<div class="ad">Buy this now, it is a really long advert that goes on and on and on for ever.</div>
<section class="comments"><p>I am a reader and this is a long comment about the article, which I liked.</p></section>
<footer>&copy; 2020 long footer text here</footer></body></html>"""


def test_main_text():
    assert html_extract.main_text(PAGE) == (
        "Title & more\nFirst é para with many words and some more words here to be long enough.\nShort.\n"
        "Another rather long paragraph, with a link and emphasis too.\nOpen one\nitem one\nitem two")
    assert html_extract.main_text("<div>" * 3000 + "x") == "x"
    assert html_extract.main_text("<nav>x<p>y</nav><p>body text") == "body text"


LONG = "A rather long paragraph of the article with many words in it, so that its ratio is high."


@pytest.mark.parametrize("inner,want", [
    (f"<h1>T</h1><p>lead</p><div class=body><p>{LONG}</p><p>{LONG}</p></div>", ["T", "lead", LONG, LONG]),
    (f"<section>{f'<p>{LONG}</p>' * 17}</section><section>{f'<p>{LONG}</p>' * 3}</section>", [LONG] * 20),
    (f"<div>{f'<p>{LONG}</p>' * 9}</div>" + "<p>No.</p>" * 6, [LONG] * 9 + ["No."] * 6),
    (f"<p>{LONG}</p><p>{LONG}</p><table><tr><td>{LONG}<td>{LONG}</table>", [LONG] * 4),
    (f"<p>{LONG}</p><ul><li><a href=a>first source</a><li>second</ul>", [LONG, "first source", "second"])])
def test_main_text_keeps_the_whole_article(inner, want):
    around = ("<nav><ul><li><a href=/>Home</a></ul></nav>", "<div class=ad>buy</div>", "<footer>end</footer>")
    for tag in ("article", "main"):
        page = f"{around[0]}<div><div>{around[1]}<{tag}>{inner}</{tag}></div></div>{around[2]}"
        assert html_extract.main_text(page).split("\n") == want


def test_main_text_without_an_article():
    inner = f"<h1>T</h1><p>lead</p><div><p>{LONG}</p><p>{LONG}</p></div><div>" + "<p>No.</p>" * 6 + "</div>"
    assert html_extract.main_text(f"<nav>menu</nav><div>{inner}</div>").split("\n") == \
        ["T", "lead", LONG, LONG] + ["No."] * 6
    menu = "<ul>" + "".join(f"<li><a href={k}>page {k}</a>" for k in range(6)) + "</ul>"
    assert html_extract.main_text(f"<div>{menu}</div><div>{inner}</div>").startswith("T\nlead\n")


ARTICLE = f"<article><h1>T</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></article>"
BODY = f"<h1>T</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
MENU = "<nav><ul><li><a href=/a>a</a><li><a href=/b>b</a></ul></nav>"
FOOT = "<footer><p>Imprint and some more words here</p></footer>"


@pytest.mark.parametrize("page", [
    f"{MENU}<div class='site no-sidebar'>{ARTICLE}</div>{FOOT}",
    f"{MENU}<div class='post category-social'>{ARTICLE}</div><div class=sidebar><p>side words</p></div>{FOOT}",
    f"<form id=aspnetForm>{MENU}{ARTICLE}<input name=q><label>Search</label>{FOOT}</form>",
    f"{MENU}<article><h1>T</h1><div class='entry related-topics'><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div></article>",
    f"<article><h1>T</h1><p style='color:red; display : none'>x {LONG}</p><p>{LONG}</p><div hidden>{LONG}</div><p>Short.</p><p>{LONG}</p></article>",
    f"<div>{''.join(f'<a href={k}>link {k}</a> ' for k in range(8))}</div><div>{BODY}</div><div class=footer>c 2020</div>",
    f"<div class=menu><a href=1>x</a></div><div class=widget>{BODY}</div>",
    f"<article><h2>Other</h2><p>See also this.</p></article><div>{BODY}</div>",
    f"{ARTICLE}<div id=comments>" + f"<article><p>{LONG} {LONG} {LONG}</p></article>" * 6 + "</div>",
    f"<article>{BODY}<section class='comment-list'><p>me too, {LONG}</p></section><form><p>Write</p><textarea>x</textarea></form></article>",
    f"<div class='cookie-notice'><p>We use cookies. {LONG}</p></div>{ARTICLE}<div class='newsletter-signup box'><p>{LONG}</p></div>",
    f"<center><table><tr><td><a href=1>a</a><td>{BODY}</table></center>",
])
def test_main_text_of_common_frames(page):
    assert html_extract.main_text(f"<!DOCTYPE html><html><body>{page}</body></html>").split("\n") == ["T", LONG, "Short.", LONG]


def test_main_text_of_two_articles():
    more = f"<article><h1>U</h1><p>{LONG}</p><p>{LONG}</p></article>"
    assert html_extract.main_text(MENU + ARTICLE + more + FOOT).split("\n") == ["T", LONG, "Short.", LONG, "U", LONG, LONG]


def test_the_clusters_choose_the_region():
    """The same page, twice: what is long and plain is the region, whatever the parts are called."""
    links = "".join(f"<p><a href={k}>a</a> <b>b</b> <i>c</i>" for k in range(12))
    text = f"<p>{LONG}</p><p>{LONG}</p>"
    one, two = f"<article>{links}</article><div>{text}</div>", f"<div>{links}</div><article>{text}</article>"
    for page in (one, two):
        assert html_extract.main_text(page).split("\n") == [LONG, LONG]


def test_seeds_equal_a_plain_recomputation():
    page = html_extract.Page()
    page.feed(f"<div><a>x</a><b>y</b></div><p>{LONG}<p>Short.<p>{LONG}<ul><li><a>z</a><li>q</ul>")
    page.close(), page.flush()
    fine = np.array([True] * len(page.lines))
    ratio = [len(t) / max(1, n) for t, _, n, _ in page.lines]
    level = []
    for i in range(len(ratio)):
        w = {j: math.exp(-0.5 * ((i - j) / html_extract.SIGMA) ** 2) for j in range(len(ratio)) if abs(i - j) <= 2}
        level.append(sum(w[j] * ratio[j] for j in w) / sum(w.values()))
    mean = sum(level) / len(level)
    cut = html_extract.SHARE * math.sqrt(sum((x - mean) ** 2 for x in level) / len(level))
    assert html_extract.seeds(page, fine).tolist() == [x >= cut for x in level]


def test_extract_rows(spark):
    long = "word " * 30_000
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "t"), (2, None, None, "t"), (3, "u", "", "t"), (None, "u", "plain", "t"), (1, "u", PAGE, "t"),
         (5, "u", f"<article><p>a<p>{long}<p>b</article>", "t")], "page_id long, url string, html string, text string")
    got = html_extract.extract(pages).collect()
    assert sorted(r.n_chars for r in got) == sorted(
        [len(html_extract.main_text(PAGE))] * 2 + [0, 0, 5, len(long) - 1 + 4])
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(pages.where("page_id = 99")).count() == 0


@pytest.mark.parametrize("rows", [7, 64, 150])
def test_neighbours_fill_k_on_small_tables(spark, rows):
    rng = np.random.default_rng(rows)
    centres = rng.normal(size=(16, 8)) * 50
    vectors = spark.createDataFrame([(i, (centres[i % 16] + rng.normal(size=8)).tolist()) for i in range(rows)],
                                    "vec_id long, embedding array<double>")
    got = Counter(r.query_id for r in ann.search(vectors, F.col("vec_id") % 3 == 0, k=10).collect())
    assert got == {i: min(10, rows - 1) for i in range(0, rows, 3)}


# ---- token files ------------------------------------------------------------------

def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 3000):
        x = rng.integers(0, 50, n).astype(np.uint32)
        m = wavelet.WaveletMatrix.build(x, 6)
        assert (m.all() == x).all()
        for i in range(0, n, 37):
            assert m.access(i) == x[i] and m.rank(int(x[i]), i) == (x[:i] == x[i]).sum()
        for v in range(0, 50, 7):
            at = np.flatnonzero(x == v)
            assert m.count(v) == len(at) and [m.select(v, k) for k in range(len(at))] == at.tolist()
            assert m.count(v, n // 3, n // 2) == (x[n // 3:n // 2] == v).sum()
        with pytest.raises(IndexError):
            m.select(51, 0)


def _encode(encode, texts):
    return encode(*X.string_buffers(pa.array(texts)))


def test_encoder_equals_the_library():
    encode = wavelet.encoder(TOKENIZER)
    assert encode.direct
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGäöüßéèñóçÀÉµªÿıŁøÆ.,!?'-_|0129<>"
    texts = ["", "a<|endoftext|>b  x", "ΑΣ ΣΑΣ\x1cfoo\xa0bar", "é ́x y it's I'LL 12345 ' s", "﻿ 你好 世界　ok",
             "a|b | || x don't. 're, l'été", " ".join(f"q{k}" for k in range(9000)),
             " ".join("".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(5000))]
    for t, ids in zip(texts, _encode(encode, texts)):
        assert ids.tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids


def test_encoder_with_equal_hashes(monkeypatch):
    real = X.words

    def poor(data, offsets, check=False):
        w = real(data, offsets, check)
        w.hash = w.hash & np.uint64(3)
        return w

    monkeypatch.setattr(X, "words", poor)
    encode, texts = wavelet.Encoder(TOKENIZER), ["a b c d e f g", "", "a a", "Long words, too."]
    for t, ids in zip(texts, _encode(encode, texts)):
        assert ids.tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids


def test_encoder_forgets_and_is_right(monkeypatch):
    monkeypatch.setattr(wavelet, "CACHED_WORDS", 5)
    encode = wavelet.Encoder(TOKENIZER)
    for texts in (["a b c", "c d"], ["d e f g", "a"], ["h i j k l m n", "a h"], ["a"]):
        for t, ids in zip(texts, _encode(encode, texts)):
            assert ids.tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("shard_bytes", [1 << 24, 60])
def test_files_give_the_ids_back(spark, docs_of, tmp_path, shard_bytes):
    rng = random.Random(2)
    texts = [None, "", "Hello, hello", "x" * 3000] + [" ".join(f"word{rng.randrange(50)}" for _ in range(9)) for _ in range(30)]
    ids = rng.sample(range(-500, 500), len(texts))
    path = str(tmp_path / "shards")
    wavelet.write(docs_of(texts, ids), path, TOKENIZER, shard_bytes=shard_bytes)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in wavelet.documents(spark, path).collect()}
    encode, at, want, times = wavelet.encoder(TOKENIZER).tokenizer, 0, {}, {}
    for i, t in sorted(zip(ids, texts)):
        row = encode.encode(t or "", add_special_tokens=False).ids + [1]
        want[i] = (at, len(row), zlib.crc32(np.array(row, "<u4").tobytes()))
        at += len(row)
        times[i] = row.count(1)
    assert got == want
    assert {r.doc_id: r.n for r in wavelet.occurrences(spark, path, 1).collect()} == times
    assert (wavelet.read(spark, path).count() > 1) == (shard_bytes < 1000)


def test_files_edges(spark, docs_of, tmp_path):
    wavelet.write(docs_of([]), str(tmp_path / "a"), TOKENIZER)
    assert wavelet.documents(spark, str(tmp_path / "a")).count() == 0
    wavelet.write(docs_of(["b", "a", "a"], ids=[None, 3, 3]), str(tmp_path / "b"), TOKENIZER)
    got = wavelet.documents(spark, str(tmp_path / "b")).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in got] == [(None, 0), (3, 2), (3, 4)]


def _changed_tokenizer(tmp_path, **parts):
    import json

    with open(TOKENIZER) as f:
        whole = json.load(f)
    path = str(tmp_path / f"{'-'.join(parts)}.json")
    with open(path, "w") as f:
        json.dump(whole | parts, f)
    return path


@pytest.mark.parametrize("parts", [{"normalizer": None}, {"pre_tokenizer": None}, {"normalizer": None, "pre_tokenizer": None}])
def test_other_tokenizers_give_the_librarys_ids(tmp_path, parts):
    """A tokenizer that keeps case, or that does not part words at white space."""
    from tokenizers import Tokenizer

    path = _changed_tokenizer(tmp_path, **parts)
    texts = ["Hello hello HELLO World", "the cat  sat\ton The mat.", "", " x ", "É é, Straße STRASSE 12 a-b", "Hello hello"]
    data, off = X.string_buffers(pa.array(texts))
    got = wavelet.Encoder(path)(data, off)
    want = Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_remembered_words_are_the_same_words(monkeypatch):
    rng = random.Random(2)
    words = [f"{rng.choice('abcXYZ')}{k}{rng.choice('.,é')}" for k in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(60)]
    data, off = X.string_buffers(pa.array(texts))
    whole = wavelet.Encoder(TOKENIZER)(data, off)
    monkeypatch.setattr(wavelet, "CACHED_WORDS", 50)
    few = wavelet.Encoder(TOKENIZER)
    parts = [x for k in range(0, 60, 3) for x in few(data[off[k]:off[k + 3]], off[k:k + 4] - off[k])]
    assert all((a == b).all() for a, b in zip(whole, parts)) and len(few.hash) <= 50 + 120
