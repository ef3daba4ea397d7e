"""Column profiles: one statistics row per column of every dataset.

Counts, distinct counts and the top-N values come from the frequency table of
:mod:`.values`; least, greatest and mean values from one typed aggregate per
dataset, without grouping and so without shuffle or sort of its rows. No
per-column action and no data on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import plan_utils as pu
from ..functions.rounding import py_round
from ..functions.semantic_type import semantic_type
from ..sources.base import orderable, quoted, type_class
from ..sources.files import read_footers
from . import values as V

#: Relative error of estimated distinct counts.
SKETCH_ERROR = 0.02


#: What :func:`typed_stats` can tell of a column, and the columns of :func:`basics` that say it.
TOLD = {"counts": ("null_count", "null_rate"), "range": ("min_value", "max_value", "min_num", "max_num"),
        "mean": ("mean_value",)}
STATISTICS = frozenset(TOLD)


def typed_stats(estate, datasets=None, sketched: frozenset = frozenset(),
                needs: frozenset = STATISTICS) -> DataFrame | None:
    """(dataset_id, ordinal, rows, known, min_value, max_value, min_num, max_num,
    mean_raw, approx_distinct) of every column: its rows and those without null, and
    its values compared in their own type and printed afterwards. The distinct count is
    estimated for the datasets of ``sketched``. What ``needs`` does not name is null, and
    a column that nothing is asked of is not read."""
    frames = []
    for scan in estate.scans(datasets):
        fields = list(enumerate(scan.fields))
        # least and greatest texts make Spark interpret a whole aggregate: they are one of their own
        texts = [x for x in fields if isinstance(x[1].dataType, T.StringType)] if "range" in needs else []
        for some in ([x for x in fields if x not in texts], texts):
            if some:
                frames.append(_typed_row(scan, some, sketched, needs))
    return reduce(DataFrame.unionAll, frames) if frames else None


def _typed_row(scan, fields, sketched: frozenset, needs: frozenset) -> DataFrame:
    """:func:`typed_stats` of some columns of a relation, by one aggregate."""
    aggs, items = [], []
    estimate = any(ds.dataset_id in sketched for ds in scan.datasets)
    for i, f in fields:
        c, dt = F.col(quoted(f.name)), f.dataType
        if isinstance(dt, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0.0).cast(dt)     # -0.0 is 0.0
        numeric = isinstance(dt, T.NumericType)
        text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
        if "range" in needs and orderable(dt) and not isinstance(dt, T.NullType):
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
            least, most = (V.printed(F.col(f"{x}{i}"), dt) for x in ("lo", "hi"))
        else:
            least = most = text
        low = high = mean = number
        if numeric and "range" in needs:
            low, high = (F.col(f"{x}{i}").cast("double") for x in ("lo", "hi"))
        if numeric and "mean" in needs:
            aggs.append(F.avg(c.cast("double")).alias(f"mean{i}"))
            mean = F.col(f"mean{i}").cast("double")
        approx = F.lit(None).cast("long")
        if estimate and type_class(dt) != "nested":
            aggs.append(F.approx_count_distinct(c, SKETCH_ERROR).alias(f"apx{i}"))
            approx = F.col(f"apx{i}")
        known = F.lit(None).cast("long")
        if "counts" in needs:
            aggs.append(F.count(c).alias(f"n{i}"))
            known = F.col(f"n{i}")
        items.append(F.struct(F.lit(i).alias("ordinal"), F.col("rows"), known.alias("known"),
                              least.alias("min_value"), most.alias("max_value"),
                              low.alias("min_num"), high.alias("max_num"), mean.alias("mean_raw"),
                              approx.alias("approx_distinct")))
    aggs = [F.count(F.lit(1)).alias("rows"), *aggs]
    if scan.single:
        row = scan.frame.agg(*aggs).withColumn("__id", scan.ident)
    else:
        row = scan.frame.groupBy(scan.ident.alias("__id")).agg(*aggs)
    return row.select(F.col("__id").alias("dataset_id"), F.inline(F.array(*items)))


TYPED_SCHEMA = ("dataset_id int, ordinal int, rows long, known long, min_value string, max_value string, "
                "min_num double, max_num double, mean_raw double, approx_distinct long")


def footer_counts(estate, datasets) -> DataFrame | None:
    """(dataset_id, ordinal, rows, known) of flat Parquet files from their footers: an
    aggregate that Spark pushes into the scan, so that no page of data is read. Its
    action fails where a footer lacks the number of nulls."""
    frames = []
    for ds in datasets:
        names = [quoted(f.name) for f in ds.schema.fields]
        row = read_footers(estate.spark, ds).agg(F.count(F.lit(1)).alias("rows"),
                                                 *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(names)])
        items = [F.struct(F.lit(i).alias("ordinal"), F.col("rows"), F.col(f"n{i}").alias("known")) for i in range(len(names))]
        frames.append(row.select(F.lit(ds.dataset_id).alias("dataset_id"), F.inline(F.array(*items))))
    return reduce(DataFrame.unionAll, frames) if frames else None


def _null_rate(nulls, rows):
    return F.coalesce(py_round(nulls / F.nullif(rows, F.lit(0)), 4), F.lit(0.0))


def basics(estate, typed: DataFrame | None) -> DataFrame:
    """What the ungrouped aggregates alone tell of every column: rows, nulls, least,
    greatest and mean values. No value goes through a shuffle."""
    if typed is None:
        typed = estate.spark.createDataFrame([], TYPED_SCHEMA)
    rows = F.coalesce("rows", F.lit(0)).cast("long")
    nulls = rows - F.coalesce("known", F.lit(0))
    return (pu.small(estate.columns(), estate.column_count).join(typed, ["dataset_id", "ordinal"], "left")
            .select("dataset_id", "source_name", "table_name", "ordinal", "column_name", "type_class",
                    rows.alias("total_rows"), nulls.alias("null_count"), _null_rate(nulls, rows).alias("null_rate"),
                    "min_value", "max_value", "min_num", "max_num", py_round(F.col("mean_raw"), 4).alias("mean_value")))


def value_stats(freq: DataFrame) -> DataFrame:
    """Row, non-null and distinct counts (a null counts as a value) per column."""
    return freq.groupBy("dataset_id", "ordinal").agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("key").isNotNull(), F.col("n"))), F.lit(0)).cast("long").alias("non_null"),
        F.count(F.lit(1)).alias("distinct_count"))


def ranked_keys(freq: DataFrame, n: int, max_chars: int | None) -> DataFrame:
    """The keys that may be among the ``n`` most frequent values of a column:
    ranked by count and by value as far as the key tells, with all ties there.
    Spark plans this as a partial per-task limit before the shuffle
    (``WindowGroupLimit``), so even a column with billions of distinct values
    sends few rows per task to the final ranking."""
    seen = F.substring("key", 1, max_chars) if max_chars else F.col("key")
    w = Window.partitionBy("dataset_id", "ordinal").orderBy(F.col("n").desc(), seen.asc_nulls_last())
    return freq.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= n).drop("rank")


def ranked_values(keyed: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent values per column, ties by value (nulls last).
    A null group takes a slot and is then dropped."""
    w = Window.partitionBy("dataset_id", "ordinal").orderBy(
        F.col("n").desc(), F.col("value").asc_nulls_last(), F.col("key").asc_nulls_last())
    return (keyed.withColumn("rank", F.row_number().over(w))
            .filter((F.col("rank") <= n) & F.col("key").isNotNull()))


def sample_lists(top: DataFrame) -> DataFrame:
    """Top values as an array ordered by rank (at most N per column)."""
    return (top.groupBy("dataset_id", "ordinal")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("__s"))
            .select("dataset_id", "ordinal",
                    F.transform("__s", lambda s: s["value"]).alias("sample_values")))


def profiles(estate, freq: DataFrame, top: DataFrame, typed: DataFrame | None) -> DataFrame:
    """The ``column_profiles`` frame (one row per column)."""
    opts = estate.options
    cols = pu.small(estate.columns(), estate.column_count)
    p = (cols.join(value_stats(freq), ["dataset_id", "ordinal"], "left")
         .join(sample_lists(top), ["dataset_id", "ordinal"], "left"))
    if typed is None:
        typed = estate.spark.createDataFrame([], TYPED_SCHEMA)
    p = p.join(typed, ["dataset_id", "ordinal"], "left")
    # an empty dataset has no values at all
    p = p.withColumn("total_rows", F.coalesce(F.col("total_rows"), F.lit(0)).cast("long"))
    null_count = F.col("total_rows") - F.coalesce(F.col("non_null"), F.lit(0))
    distinct = F.coalesce(F.col("distinct_count"), F.lit(0)).cast("long")
    samples_col = F.coalesce(F.col("sample_values"), F.array().cast("array<string>"))
    is_unique = (distinct == F.col("total_rows")) & (F.col("total_rows") > 0)
    p = p.select(
        "dataset_id", "source_type", "source_name", "table_name", "ordinal", "column_name",
        "dtype", "type_class", "total_rows",
        null_count.alias("null_count"),
        _null_rate(null_count, F.col("total_rows")).alias("null_rate"),
        distinct.alias("distinct_count"),
        is_unique.alias("is_unique"),
        "min_value", "max_value", "min_num", "max_num",
        py_round(F.col("mean_raw"), 4).alias("mean_value"),
        samples_col.alias("sample_values"))
    return p.select(
        "*",
        semantic_type(F.col("column_name"), F.col("type_class"), F.col("sample_values"),
                      F.col("is_unique"), opts.name_match).alias("inferred_type"),
        (F.col("is_unique") & (F.col("null_count") == 0) & (F.col("total_rows") > 0))
        .alias("pk_candidate"))
