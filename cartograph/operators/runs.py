"""Result tables, run records, artefacts, the run summary and the review queue."""

from __future__ import annotations

import json
from datetime import datetime, timezone
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from . import tables

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_ts", T.TimestampType(), False),
    T.StructField("config_json", T.StringType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("summary_json", T.StringType()),
    T.StructField("artefacts_dir", T.StringType()),
])


def new_run_id(now: datetime | None = None) -> str:
    """``run_<UTC yyyymmdd_hhmmss>_<6 hex>``."""
    now = now or datetime.now(timezone.utc)
    return f"run_{now.strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:6]}"


def table_name(options, key: str) -> str:
    return f"{options.output_schema}.{options.tables.get(key, key)}"


def ensure_schema(spark: SparkSession, options) -> None:
    """K7."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {options.output_schema}")


def _path(options, location: str | None, table: str) -> str | None:
    return f"{location.rstrip('/')}/{table}" if location else None


def write_result(df: DataFrame, options, key: str, run_id: str, run_ts: datetime,
                 location: str | None = None) -> str:
    """K1-K5: append this run's rows (keyed by ``run_id``) to the result
    table, creating it on first use and adding columns it does not have yet
    (:mod:`.tables`). Which run is current is told by the run records
    (:func:`latest_run_id`), so an empty result needs no row."""
    name = table_name(options, key)
    out = df.select(F.lit(run_id).alias("run_id"),
                    F.lit(run_ts).cast("timestamp").alias("run_ts"), "*")
    tables.append(out, name, options.table_format, _path(options, location, options.tables.get(key, key)))
    return name


def string_form(df: DataFrame) -> DataFrame:
    """The result as stored text: arrays, maps and structs as JSON strings
    (``columns``, ``raw_schema``, ``extra``, ``sample_values``)."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def register_json_view(spark: SparkSession, table: str) -> str:
    """``<schema>_<table>_json``: a temporary view of the table in its string form."""
    view = table.replace(".", "_") + "_json"
    string_form(spark.read.table(table)).createOrReplaceTempView(view)
    return view


def write_run_record(spark: SparkSession, options, run_id: str, run_ts: datetime, status: str,
                     summary: dict, artefacts_dir: str, location: str | None = None,
                     jdbc_sources: tuple = ()) -> None:
    """K6: one row per run, always (also on failure or no data)."""
    row = [(run_id, run_ts, json.dumps(options.snapshot(jdbc_sources), default=str), status,
            json.dumps(summary, default=str), artefacts_dir)]
    tables.append(spark.createDataFrame(row, RUNS_SCHEMA), f"{options.output_schema}.{C.TABLE_RUNS}",
                  options.table_format, _path(options, location, C.TABLE_RUNS))


def write_artefact(df: DataFrame, directory: str, name: str) -> str:
    """K8: a small JSON artefact (bounded rows: top-20, PII list, summary),
    written as one file."""
    path = f"{directory.rstrip('/')}/{name}"
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_artefact(spark: SparkSession, directory: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """An artefact's rows; an artefact without rows has no schema of its own, so that of ``schema``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(f"{directory.rstrip('/')}/{name}")


def json_artefact(spark: SparkSession, directory: str, name: str, data: dict) -> str:
    df = spark.createDataFrame([(json.dumps(data, default=str),)], "value string")
    path = f"{directory.rstrip('/')}/{name}"
    df.coalesce(1).write.mode("overwrite").text(path)
    return path


def summary_counts(profiles: DataFrame, candidates: DataFrame, semantic: DataFrame,
                   datasets: DataFrame) -> DataFrame:
    """The run's counts as one row (each a scalar subquery over its table)."""
    spark = profiles.sparkSession
    rel = candidates.agg(
        F.count_if(F.col("status") == "auto_accepted").alias("a"),
        F.count_if(F.col("status") == "needs_review").alias("r"),
        F.count_if(F.col("status") == "discarded").alias("d"))
    sem = semantic.agg(
        F.count_if(F.col("status") == "auto_accepted").alias("a"),
        F.count_if(F.col("status") == "needs_review").alias("r"),
        F.count_if(F.col("sensitivity") == "pii").alias("p"))
    prof = profiles.agg(F.count(F.lit(1)).alias("c"), F.count_if("pk_candidate").alias("k"))
    return spark.range(1).select(
        datasets.select(F.count(F.lit(1))).scalar().alias("datasets_found"),
        prof.select("c").scalar().alias("columns_profiled"),
        prof.select("k").scalar().alias("pk_candidates"),
        rel.select("a").scalar().alias("rel_auto_accepted"),
        rel.select("r").scalar().alias("rel_needs_review"),
        rel.select("d").scalar().alias("rel_discarded"),
        sem.select("a").scalar().alias("sem_auto_accepted"),
        sem.select("r").scalar().alias("sem_needs_review"),
        sem.select("p").scalar().alias("pii_columns"))


def pii_columns(semantic: DataFrame) -> DataFrame:
    """P11."""
    return (semantic.filter(F.col("sensitivity") == "pii")
            .select("source_name", "table_name", "column_name", "business_label", "confidence"))


def needs_review(df: DataFrame) -> DataFrame:
    """P10, the most confident first, ties by name (O3)."""
    names = ("source_table", "source_col", "target_table", "target_col", "source_name", "table_name", "column_name")
    return (df.filter(F.col("status") == "needs_review")
            .orderBy(F.col("confidence").desc(), *[c for c in names if c in df.columns]))


def review_counts(relationships: DataFrame, semantic: DataFrame) -> DataFrame:
    """Pending items per kind."""
    rel = needs_review(relationships).select(F.lit("relationships").alias("kind"))
    sem = needs_review(semantic).select(F.lit("semantics").alias("kind"))
    kinds = relationships.sparkSession.createDataFrame(
        [("relationships",), ("semantics",)], "kind string")
    counts = rel.unionByName(sem).groupBy("kind").agg(F.count(F.lit(1)).alias("pending"))
    return kinds.join(counts, "kind", "left").select(
        "kind", F.coalesce("pending", F.lit(0)).cast("long").alias("pending"))


def latest_run_id(spark: SparkSession, options) -> str | None:
    """The newest run that completed, as the run records have it."""
    row = (read_table(spark, f"{options.output_schema}.{C.TABLE_RUNS}", RUNS_SCHEMA)
           .filter(F.col("status") == "complete").orderBy(F.desc("run_ts"), F.desc("run_id")).first())
    return row["run_id"] if row else None


def of_run(df: DataFrame, run_id: str | None) -> DataFrame:
    """A result table's rows of one run (none without one)."""
    return df.filter(F.lit(False) if run_id is None else F.col("run_id") == run_id)


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """S15 with Q14/Q24: a missing table is an empty frame with a schema; columns of
    ``schema`` that an older table lacks are nulls."""
    if spark.catalog.tableExists(name):
        found = spark.read.table(name)
        return tables.conform(found, schema, keep_others=True) if schema else found
    return spark.createDataFrame([], schema or T.StructType(
        [T.StructField("run_id", T.StringType()), T.StructField("run_ts", T.TimestampType()),
         T.StructField("status", T.StringType()), T.StructField("confidence", T.DoubleType())]))
