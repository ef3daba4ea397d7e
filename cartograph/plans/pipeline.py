"""``run_pipeline``: a list of named phases over one run's state.

Each phase is a handful of set-based Spark jobs whose results are appended to
a table with the run's id. One helper times the phases and stops where one
finds nothing to go on with; a run record is written whatever happens.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import plan_utils as pu
from ..config import TABLE_RUNS, TOP_ARTEFACT_ROWS, Options
from ..operators import relate as R
from ..operators import runs as RUN
from ..operators import semantic as SEM
from ..sources.discovery import discover
from .analysis import Analysis

PROFILE_COLUMNS = [
    "dataset_id", "source_type", "source_name", "table_name", "ordinal", "column_name", "dtype",
    "type_class", "total_rows", "null_count", "null_rate", "distinct_count", "is_unique",
    "min_value", "max_value", "min_num", "max_num", "mean_value", "sample_values",
    "inferred_type", "pk_candidate"]


class NothingToDo(Exception):
    """A phase found nothing for the next ones."""


@dataclass
class Run:
    """What the phases of one run share."""

    spark: SparkSession
    paths: Any
    options: Options
    jdbc_sources: tuple
    location: str | None
    artefacts: str
    run_id: str = field(default_factory=RUN.new_run_id)
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    warnings: list = field(default_factory=list)
    seconds: dict = field(default_factory=dict)
    estate: Any = None
    analysis: Analysis | None = None
    tables: dict = field(default_factory=dict)

    def store(self, key: str, df: DataFrame) -> None:
        self.tables[key] = RUN.write_result(df, self.options, key, self.run_id, self.run_ts, self.location)

    def rows(self, key: str) -> DataFrame:
        return RUN.of_run(self.spark.read.table(self.tables[key]), self.run_id)

    def note(self, name: str, data: dict) -> None:
        RUN.json_artefact(self.spark, self.artefacts, name, data)


def _discovery(run: Run) -> None:
    run.estate = discover(run.spark, run.paths, run.jdbc_sources, run.options)
    try:
        run.store("discovery", run.estate.inventory())
    except Exception:
        run.estate = run.estate.countable()  # without the datasets that cannot be counted
        run.store("discovery", run.estate.inventory())
    run.warnings += run.estate.warnings
    if not run.estate.datasets:
        raise NothingToDo


def _profiling(run: Run) -> None:
    run.analysis = Analysis(run.estate, run.run_id)
    profiles = run.analysis.profiles
    run.warnings += run.analysis.failures
    run.estate = run.analysis.estate
    run.store("profiling", profiles.select(*PROFILE_COLUMNS))


def _relationship(run: Run) -> None:
    profiles = run.rows("profiling")
    run.store("relationship", R.candidates(run.estate, run.analysis.column_values, profiles, run.options, run.run_id))
    if run.options.max_cols_per_table is not None:
        RUN.write_artefact(R.left_out_columns(profiles, run.options), run.artefacts, "left_out_columns")


def _semantic(run: Run) -> None:
    profiles = run.rows("profiling")
    replies = SEM.ask(profiles, run.options, scratch=run.run_id)
    run.store("semantic", SEM.annotations(replies, profiles, run.options))
    failed = SEM.failures(replies).collect()  # a row a failed table
    run.warnings += [(f"{r['source_name']}.{r['table_name']}", f"semantic model: {r['error']}") for r in failed]


PHASES = [("discovery", _discovery), ("profiling", _profiling),
          ("relationship", _relationship), ("semantic", _semantic)]


def _results(run: Run) -> dict:
    """The counts of a whole run, and its views and small artefacts."""
    rels, semantic, profiles = (run.rows(k) for k in ("relationship", "semantic", "profiling"))
    for name in run.tables.values():
        RUN.register_json_view(run.spark, name)
    RUN.write_artefact(R.ordered(rels).limit(TOP_ARTEFACT_ROWS), run.artefacts, "relationship_candidates")
    RUN.write_artefact(RUN.pii_columns(semantic), run.artefacts, "pii_summary")
    n = RUN.summary_counts(profiles, rels, semantic, run.estate.datasets_frame()).first()
    return {
        "total_duration_sec": round(sum(run.seconds.values()), 1),
        "phase_durations": {f"{k}_sec": v for k, v in run.seconds.items()},
        "datasets_found": n["datasets_found"], "columns_profiled": n["columns_profiled"],
        "pk_candidates": n["pk_candidates"],
        "relationship_candidates": {k: n[f"rel_{k}"] for k in ("auto_accepted", "needs_review", "discarded")},
        "semantic_annotations": {"auto_accepted": n["sem_auto_accepted"],
                                 "needs_review": n["sem_needs_review"], "pii_columns": n["pii_columns"]},
        "warnings": len(run.warnings), "artefacts_dir": run.artefacts,
    }


def run_pipeline(spark: SparkSession, paths=(), options: Options | None = None,
                 jdbc_sources=(), table_location: str | None = None) -> dict:
    """Run all phases and return the summary. ``table_location`` puts the
    result tables under a folder (external tables); by default they are managed
    tables of the session catalog. A table that cannot be read, or whose model
    call fails, is a warning of the run (in its artefacts) and nothing more."""
    options = options or Options()
    run = Run(spark, paths, options, tuple(jdbc_sources), table_location, "")
    run.artefacts = f"{(options.artefacts_path or pu.scratch_path(spark, 'artefacts')).rstrip('/')}/{run.run_id}"
    summary: dict = {"status": "failed", "run_id": run.run_id, "run_ts": run.run_ts.isoformat()}
    try:
        RUN.ensure_schema(spark, options)
        run.note("config_snapshot", options.snapshot(run.jdbc_sources))
        for name, phase in PHASES:
            began = time.time()
            phase(run)
            run.seconds[name] = round(time.time() - began, 1)
        summary |= {"status": "complete"} | _results(run)
    except NothingToDo:
        summary["status"] = "stopped_no_data"
    except Exception as exc:
        summary["error"] = str(exc)
        raise
    finally:
        RUN.ensure_schema(spark, options)
        RUN.write_run_record(spark, options, run.run_id, run.run_ts, summary["status"], summary,
                             run.artefacts, table_location, run.jdbc_sources)
        if run.warnings:
            run.note("warnings", {"warnings": [list(w) for w in run.warnings]})
        run.note("pipeline_summary", summary)
        pu.remove_scratch(spark, run.run_id)
        if run.estate is not None:
            run.estate.release()
    return summary


def get_review_queue(spark: SparkSession, options: Options | None = None) -> dict:
    """Entry 2: what the newest complete run left for review, per kind."""
    options = options or Options()
    run_id = RUN.latest_run_id(spark, options)
    rel, sem = (RUN.needs_review(RUN.of_run(RUN.read_table(spark, RUN.table_name(options, k)), run_id))
                for k in ("relationship", "semantic"))
    return {"relationships_pending_review": rel.count(),
            "semantics_pending_review": sem.count(),
            "relationship_df": rel, "semantic_df": sem}


def run_history(spark: SparkSession, options: Options | None = None) -> DataFrame:
    """Past runs, newest first (O3)."""
    options = options or Options()
    runs = RUN.read_table(spark, f"{options.output_schema}.{TABLE_RUNS}", RUN.RUNS_SCHEMA)
    return runs.orderBy(F.col("run_ts").desc(), F.col("run_id").desc())
