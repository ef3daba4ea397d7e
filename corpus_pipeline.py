"""A corpus pipeline over ``documents``: stages of (name, function).

Each function takes (spark, docs, sf_dir) and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartograph.llm import common as C
from cartograph.llm import decontaminate, langid, line_align, ngram_join, packing


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not identified, or with less than even odds, go."""
    return langid.keep_identified(docs, least=0.5)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document has too are cut; documents of which nothing is left go."""
    return line_align.drop_repeated(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5-word shingles, Jaccard 0.8) the smallest doc_id stays."""
    return ngram_join.one_per_group(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, C.table(spark, sf_dir, "benchmark"), size=5, least=0.8)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document that is left goes."""
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The stages learn models and align texts; SQL has no words for that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
