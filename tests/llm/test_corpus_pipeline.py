"""The registered queries and the pipeline against sf0.001, and the entry without them."""

import os
import subprocess
import sys

import corpus_pipeline

from cartograph.llm import decontaminate, line_dedup, packing, queries


SF001 = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    import __spark_entry__ as E
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = docs.columns
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.C.written(stage(spark, docs, SF001), f"test-{name}")
        if name != "best_fit_packing":
            assert docs.columns == names
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and len(ids) > 100
        if name == "line_dedup":
            assert docs.where("n_chars <> length(text)").count() == before.where("n_chars <> length(text)").count()
        if name == "benchmark_decontamination":
            held = {r.doc_id for r in decontaminate.find(before, bench).collect()}
            assert held and ids == {r.doc_id for r in before.collect()} - held
    assert {r.doc_id for r in docs.collect()} == ids
    assert line_dedup.MIN_WORDS == 25 and packing.CAPACITY == 2048


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.C.written(stage(spark, docs, SF001), f"empty-{name}")
        assert docs.count() == 0


def test_the_entry_works_without_the_operators():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as E; "
            "assert len(E.queries()) > 30 and not any(n.startswith('op') for n in E.queries())")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
