"""The ``opN_`` queries: each applies its operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import plan_utils as pu
from . import common as C
from . import ann, ctw, decontaminate, divergence, html_extract, langid, line_align, ngram_join, packing, periodic
from . import quality, toxicity, wavelet


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_align.dedup(C.table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"),
                              size=5, least=0.8, radius=24)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(C.table(spark, sf_dir, "documents"), size=3, percent=90)


def op4_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = C.fold("doc_id", 7) == 2
    docs = C.table(spark, sf_dir, "documents")
    return ctw.score(docs, train_on=~held_out).withColumn("held_out", held_out)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(C.table(spark, sf_dir, "pages"))


def op6_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = pu.scratch_path(spark, "llm", "token-shards", uuid.uuid4().hex[:8])
    wavelet.write(C.table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return wavelet.documents(spark, path)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(C.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(C.table(spark, sf_dir, "documents"), capacity=2048)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(C.table(spark, sf_dir, "documents"), folds=5, held_out=0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"), folds=5, held_out=0)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"), folds=5, held_out=0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(C.table(spark, sf_dir, "documents"), min_docs=10, top=10)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.runs(C.table(spark, sf_dir, "documents"), plant=True)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_decontamination, op3_ngram_jaccard_join, op4_context_tree_weighting, op5_html_extraction,
    op6_wavelet_tokens, op7_nearest_neighbours, op8_best_fit_packing, op9_language_id, op10_toxicity,
    op11_quality, op12_source_divergence, op13_periodic_runs,
)}

#: The join as plain SQL: every pair's overlap, then labels spread until they rest.
_OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * o >= 90 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents
      UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.a)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.c) AS component_id,
       (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id
"""

#: The audit as plain SQL: every kept term beside every group.
_OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(t) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY lang, source, term),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS of_lang
      FROM g JOIN k ON k.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n) AS n FROM f GROUP BY lang, source),
p AS (SELECT f.lang, f.source, f.term, f.n,
             1 + (1000000000::HUGEINT * (f.n + 2)) // (s.n + 2 * l.v) AS p,
             1 + (1000000000::HUGEINT * (f.of_lang + 2)) // (l.n + 2 * l.v) AS q
      FROM f JOIN s ON s.lang = f.lang AND s.source = f.source JOIN l ON l.lang = f.lang),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY a.lang, a.source, b.source),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
z AS (SELECT lang, source, part, item, value::BIGINT AS value,
             (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM u)
SELECT * FROM z WHERE part = 'pair' OR rank <= 10
"""

ORACLE_SQL = {"op3_ngram_jaccard_join": _OP3_SQL, "op12_source_divergence": _OP12_SQL}
