"""The whole run: tables, run records, review queue, history, entry points."""

import json

from cartograph import KEY_DISCOVERY, get_review_queue, run_history, run_pipeline

SF = "/root/testdata/sf0.001"


def test_two_runs_and_queue(spark, tmp_path):
    opts = KEY_DISCOVERY.replace(provider="rules", output_schema="cg_pipe",
                                 artefacts_path=str(tmp_path / "art"))
    s1 = run_pipeline(spark, SF, opts, table_location=str(tmp_path / "tables"))
    assert s1["status"] == "complete"
    assert (s1["datasets_found"], s1["columns_profiled"], s1["pk_candidates"]) == (14, 63, 27)
    assert s1["relationship_candidates"] == {"auto_accepted": 22, "needs_review": 107,
                                             "discarded": 38}
    s2 = run_pipeline(spark, SF, opts.replace(provider="stub"),
                      table_location=str(tmp_path / "tables"))
    assert s2["semantic_annotations"]["auto_accepted"] == 0
    hist = run_history(spark, opts).collect()
    assert [r.run_id for r in hist] == [s2["run_id"], s1["run_id"]]
    q = get_review_queue(spark, opts)
    assert q["relationships_pending_review"] == 107      # latest run only
    assert q["semantics_pending_review"] == 0            # stub: everything low_confidence
    js = spark.table("cg_pipe_profiling_results_json").filter(f"run_id = '{s2['run_id']}'")
    assert js.schema["sample_values"].dataType.typeName() == "string"
    assert js.filter("column_name = 'r_name'").first().sample_values.startswith('["')
    top = spark.read.json(str(tmp_path / "art" / s1["run_id"] / "relationship_candidates"))
    assert top.count() == 20
    summary = json.loads(spark.read.text(
        str(tmp_path / "art" / s1["run_id"] / "pipeline_summary")).first().value)
    assert summary["run_id"] == s1["run_id"]


def test_no_data_writes_one_run_row(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.txt").write_text("no tables here")
    opts = KEY_DISCOVERY.replace(output_schema="cg_nodata", artefacts_path=str(tmp_path / "a"))
    s = run_pipeline(spark, str(tmp_path / "empty"), opts, table_location=str(tmp_path / "t"))
    assert s["status"] == "stopped_no_data"
    assert [r.status for r in run_history(spark, opts).collect()] == ["stopped_no_data"]


def test_entry_flagship(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 167
    assert sum(r.status == "auto_accepted" for r in rows) == 22
    assert [r.confidence for r in rows] == sorted((r.confidence for r in rows), reverse=True)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_failure_still_writes_run_row(spark, tmp_path):
    import pytest

    opts = KEY_DISCOVERY.replace(provider="no-such-provider", output_schema="cg_fail",
                                 artefacts_path=str(tmp_path / "a"))
    with pytest.raises(Exception):
        run_pipeline(spark, SF, opts, table_location=str(tmp_path / "t"))
    assert [r.status for r in run_history(spark, opts).collect()] == ["failed"]


def test_queue_of_missing_tables_is_empty(spark):
    q = get_review_queue(spark, KEY_DISCOVERY.replace(output_schema="cg_never_written"))
    assert q["relationships_pending_review"] == 0
    assert "confidence" in q["relationship_df"].columns
