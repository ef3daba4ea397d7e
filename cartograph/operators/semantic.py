"""Semantic annotation: one prompt per table, a provider, reply parsing.

Prompts are built from the profiles with array functions (one row per
table); the stub and rule providers are native column expressions, and a
user model is called through ``mapInPandas`` on the executors, one row per
table. Replies are parsed with ``from_json``; a reply that is not a JSON
array of objects falls back to a placeholder per column.
"""

from __future__ import annotations

import threading
import time
import uuid
from typing import Any, Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .. import plan_utils as pu
from ..functions.rounding import py_round
from ..functions.scoring import tier
from ..functions.text import py_strip, py_title

REPLIES_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.IntegerType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("error", T.StringType()),
])


def _pct(x: Column) -> Column:
    """Python ``f"{x:.0%}"``."""
    return F.concat(py_round(x * F.lit(100.0), 0).cast("long").cast("string"), F.lit("%"))


def column_line(p: DataFrame) -> Column:
    samples = F.array_join(F.slice(F.col("sample_values"), 1, C.PROMPT_SAMPLES), ", ")
    return F.concat(F.lit("  - "), F.col("column_name"), F.lit(" | "), F.col("dtype"),
                    F.lit(" | "), F.coalesce(F.col("inferred_type"), F.lit("unknown")),
                    F.lit(" | ["), samples, F.lit("]"))


def prompts(profiles: DataFrame) -> DataFrame:
    """(dataset_id, source_name, table_name, prompt, columns). A group
    holds one table's columns: bounded by the schema's width."""
    g = (profiles.withColumn("__line", column_line(profiles))
         .groupBy("dataset_id", "source_name", "table_name")
         .agg(F.array_sort(F.collect_list(F.struct("ordinal", "__line", "column_name")))
              .alias("__lines"),
              F.min_by("total_rows", "ordinal").alias("__rows"),
              F.min("null_rate").alias("__nmin"), F.max("null_rate").alias("__nmax")))
    prompt = F.concat_ws(
        "\n",
        F.concat(F.lit("Table name: "), F.col("table_name")),
        F.lit(""),
        F.lit("Columns (name | type | inferred_type | sample_values):"),
        F.transform("__lines", lambda s: s["__line"]),
        F.lit(""),
        F.lit("Additional context:"),
        F.concat(F.lit("  - Total rows sampled: "), F.col("__rows").cast("string")),
        F.concat(F.lit("  - Null rates range: "), _pct(F.col("__nmin")), F.lit(" – "),
                 _pct(F.col("__nmax"))))
    return g.select("dataset_id", "source_name", "table_name", prompt.alias("prompt"),
                    F.transform("__lines", lambda s: s["column_name"]).alias("columns"))


# ---- providers ----------------------------------------------------------------

def stub_reply(prompt: Column) -> Column:
    """fixed text with the prompt length; not JSON, so every column
    falls back."""
    head, tail = C.STUB_RESPONSE.split("{n}")
    return F.concat(F.lit(head), F.length(prompt).cast("string"), F.lit(tail))


def _rule_sensitivity(inferred: Column, name: Column) -> Column:
    lname = F.lower(name)
    return (F.when(inferred.isin("email", "label_or_name", "geographic"), F.lit("pii"))
             .when(lname.rlike("(phone|address|e_?mail|ssn)"), F.lit("pii"))
             .when(inferred == "monetary_amount", F.lit("high"))
             .when(inferred == "identifier", F.lit("medium"))
             .otherwise(F.lit("low")))


RULE_CONFIDENCE = {
    "email": 0.95, "identifier": 0.9, "datetime": 0.9, "boolean_flag": 0.9,
    "monetary_amount": 0.85, "label_or_name": 0.7, "geographic": 0.7, "numeric": 0.6,
    "unique_text": 0.5, "categorical_or_text": 0.5, "nested": 0.4, "unknown": 0.3,
}


def _rule_confidence(inferred: Column) -> Column:
    out = None
    for k, v in RULE_CONFIDENCE.items():
        out = (F.when(inferred == k, F.lit(v)) if out is None else out.when(inferred == k, F.lit(v)))
    return out.otherwise(F.lit(0.3))


def rule_items(profiles: DataFrame) -> DataFrame:
    """An offline annotator following the model contract's sensitivity
    rules (names, e-mails, addresses -> pii; money -> high; identifiers ->
    medium; times, flags, counts -> low)."""
    label = py_title(F.regexp_replace("column_name", "_", " "))
    return profiles.select(
        "dataset_id", "ordinal", "column_name",
        label.alias("business_label"),
        F.concat(label, F.lit(" ("), F.col("inferred_type"), F.lit(")")).alias("description"),
        _rule_sensitivity(F.col("inferred_type"), F.col("column_name")).alias("sensitivity"),
        _rule_confidence(F.col("inferred_type")).alias("confidence"))


def rule_replies(prompts_df: DataFrame, profiles: DataFrame) -> DataFrame:
    """The rule annotator's answer per table, as a JSON array text."""
    items = rule_items(profiles)
    obj = F.struct("column_name", "business_label", "description", "sensitivity", "confidence")
    per_table = (items.groupBy("dataset_id")
                 .agg(F.array_sort(F.collect_list(F.struct("ordinal", obj.alias("o")))).alias("__o"))
                 .select("dataset_id", F.to_json(F.transform("__o", lambda s: s["o"])).alias("raw")))
    return prompts_df.join(per_table, "dataset_id").select(
        "dataset_id", "source_name", "table_name", "raw")


def _ask(fn: Callable[[pd.DataFrame], Any], pdf: pd.DataFrame) -> list:
    out = fn(pdf[["source_name", "table_name", "prompt"]].assign(system_prompt=C.SYSTEM_PROMPT))
    raw = list(out["raw"] if isinstance(out, pd.DataFrame) else out)
    if len(raw) != len(pdf):
        raise ValueError(f"provider returned {len(raw)} replies for {len(pdf)} prompts")
    return raw


def _ask_in_time(fn: Callable[[pd.DataFrame], Any], pdf: pd.DataFrame, timeout: float | None) -> list:
    """A call that is given up after ``timeout`` seconds; its thread is left behind."""
    if timeout is None:
        return _ask(fn, pdf)
    box: dict[str, Any] = {}

    def call() -> None:
        try:
            box["raw"] = _ask(fn, pdf)
        except BaseException as exc:
            box["error"] = exc

    thread = threading.Thread(target=call, daemon=True)
    thread.start()
    thread.join(timeout)
    if "error" in box:
        raise box["error"]
    if "raw" not in box:
        raise TimeoutError(f"no reply within {timeout:g} s")
    return box["raw"]


def _call_tables(fn: Callable[[pd.DataFrame], Any], timeout: float | None = None, attempts: int = 1):
    """One table a call: a call that fails, or hangs, loses only that table's reply
    after ``attempts`` calls, and its last error is kept."""
    def reply(pdf):
        for k in range(max(1, attempts)):
            try:
                return _ask_in_time(fn, pdf, timeout)[0], None
            except Exception as exc:
                error = f"{type(exc).__name__}: {exc}"[:1000]
            if k + 1 < attempts:
                time.sleep(min(5.0, 0.5 * 2 ** k))
        return None, error

    def run(batches):
        for pdf in batches:
            found = [reply(pdf.iloc[[i]]) for i in range(len(pdf))]
            yield pd.DataFrame({"dataset_id": pdf["dataset_id"].values,
                                "source_name": pdf["source_name"].values,
                                "table_name": pdf["table_name"].values,
                                "raw": pd.Series([r for r, _ in found], dtype="string").values,
                                "error": pd.Series([e for _, e in found], dtype="string").values})
    return run


def replies(prompts_df: DataFrame, profiles: DataFrame, provider: Any, options=None,
            scratch: str | None = None) -> DataFrame:
    """``"stub"``, ``"rules"``, or a function of a pandas frame
    (source_name, table_name, prompt, system_prompt) returning the replies; it
    runs on the executors, once for each table, in ``model_tasks`` tasks.

    Tables are asked in waves of ``model_wave`` calls a task, and the replies of a
    wave are written before the next one begins: labels, fallbacks and stored
    replies all come from the same call, and a lost executor costs the calls of
    its running tasks, not those that were answered. A call that takes longer than
    ``model_timeout`` seconds counts as failed."""
    options = options or C.Options()
    none = F.lit(None).cast("string").alias("error")
    if isinstance(provider, str) and provider == "stub":
        return prompts_df.select("dataset_id", "source_name", "table_name",
                                 stub_reply(F.col("prompt")).alias("raw"), none)
    if isinstance(provider, str) and provider == "rules":
        return rule_replies(prompts_df, profiles).select("*", none)
    if callable(provider):
        spark = prompts_df.sparkSession
        tasks = options.model_tasks or spark.sparkContext.defaultParallelism
        folder = scratch or f"model-{uuid.uuid4().hex[:12]}"
        asked = pu.materialize(prompts_df.select("dataset_id", "source_name", "table_name", "prompt"), spark, folder, "prompts")
        waves = max(1, -(-asked.count() // (tasks * max(1, options.model_wave))))
        path = pu.scratch_path(spark, folder, "replies")
        call = _call_tables(provider, options.model_timeout, options.model_attempts)
        for k in range(waves):
            wave = asked.filter(F.pmod(F.xxhash64("dataset_id"), F.lit(waves)) == k)
            (wave.repartition(tasks, "dataset_id").mapInPandas(call, REPLIES_SCHEMA)
             .write.mode("append").parquet(path))
        return spark.read.schema(REPLIES_SCHEMA).parquet(path)
    raise ValueError(f"Unknown provider: {provider!r}")


def failures(replies_df: DataFrame) -> DataFrame:
    """(source_name, table_name, error) of the tables whose call failed."""
    return replies_df.filter(F.col("error").isNotNull()).select("source_name", "table_name", "error")


# ---- parsing ------------------------------------------------------------------

def _field(e: Column, name: str) -> Column:
    return F.get_json_object(e, f"$.{name}")


def json_items(text: Column) -> Column:
    """The items of a JSON array of objects (each as JSON text), or null when
    the text is not one, an item is not an object, or a confidence is not
    a number."""
    arr = F.from_json(text, T.ArrayType(T.StringType()), {"allowSingleQuotes": "false"})
    ok_item = (lambda e: e.rlike(r"^\s*\{")
               & (_field(e, "confidence").isNull()
                  | _field(e, "confidence").try_cast("double").isNotNull()))
    ok = text.rlike(r"^\s*\[") & arr.isNotNull() & F.coalesce(F.forall(arr, ok_item), F.lit(False))
    return F.when(ok, arr)


def parse_items(raw: Column) -> Column:
    """strip code fences; the whole text; else the first ``[...]``
    (shortest); else the widest ``[...]``."""
    cleaned = py_strip(F.regexp_replace(raw, r"```(?:json)?|```", ""))
    first = F.regexp_extract(cleaned, r"(?s)(\[.*?\])", 1)
    widest = F.regexp_extract(cleaned, r"(?s)(\[.*\])", 1)
    return F.coalesce(json_items(cleaned), json_items(first), json_items(widest))


def annotations(replies_df: DataFrame, profiles: DataFrame, options) -> DataFrame:
    """One row per reply item; a placeholder (F14) for every column
    of a table whose reply does not parse, and for columns a reply leaves out."""
    r = replies_df.withColumn("__items", parse_items(F.col("raw")))
    raw_cut = (F.col("raw") if options.raw_response_chars is None
               else F.substring(F.col("raw"), 1, options.raw_response_chars))
    parsed = (r.filter(F.col("__items").isNotNull())
              .select("dataset_id", "source_name", "table_name", raw_cut.alias("raw_response"),
                      F.posexplode("__items").alias("item_pos", "e"))
              .select("dataset_id", "source_name", "table_name", "raw_response", "item_pos",
                      F.coalesce(_field(F.col("e"), "column_name"), F.lit("")).alias("column_name"),
                      F.coalesce(_field(F.col("e"), "business_label"), F.lit("")).alias("business_label"),
                      F.coalesce(_field(F.col("e"), "description"), F.lit("")).alias("description"),
                      F.coalesce(_field(F.col("e"), "sensitivity"), F.lit(C.DEFAULT_SENSITIVITY))
                      .alias("sensitivity"),
                      F.coalesce(_field(F.col("e"), "confidence").try_cast("double"),
                                 F.lit(C.DEFAULT_CONFIDENCE)).alias("confidence"),
                      F.lit(True).alias("from_reply")))
    cols = profiles.select("dataset_id", "ordinal", "column_name")
    answered = parsed.select("dataset_id", "column_name").distinct()
    meta = r.select("dataset_id", "source_name", "table_name", raw_cut.alias("raw_response"))
    missing = cols.join(answered, ["dataset_id", "column_name"], "left_anti")
    fallback = (missing.join(meta, "dataset_id")
                .select("dataset_id", "source_name", "table_name", "raw_response",
                        (F.lit(1_000_000) + F.col("ordinal")).alias("item_pos"), "column_name",
                        py_title(F.regexp_replace("column_name", "_", " ")).alias("business_label"),
                        F.lit(C.FALLBACK_DESCRIPTION).alias("description"),
                        F.lit(C.FALLBACK_SENSITIVITY).alias("sensitivity"),
                        F.lit(C.FALLBACK_CONFIDENCE).alias("confidence"),
                        F.lit(False).alias("from_reply")))
    out = parsed.unionByName(fallback)
    return out.select(
        "dataset_id", "source_name", "table_name", "item_pos", "column_name", "business_label",
        "description", "sensitivity", "confidence",
        tier(F.col("confidence"), options.auto_accept, options.human_review, "low_confidence")
        .alias("status"),
        "raw_response", "from_reply")


def ask(profiles: DataFrame, options, provider: Any | None = None, scratch: str | None = None) -> DataFrame:
    """The replies for every table of ``profiles``; a model's are written under ``scratch``."""
    return replies(prompts(profiles), profiles, options.provider if provider is None else provider, options, scratch)


def annotate(profiles: DataFrame, options, provider: Any | None = None) -> DataFrame:
    return annotations(ask(profiles, options, provider), profiles, options)
