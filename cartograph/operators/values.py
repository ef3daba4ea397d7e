"""The frequency table ``column_values``: one row per (dataset, column, value).

Every column of every dataset is un-pivoted (an ``Expand`` node, no array per
row) and counted with one ``groupBy``: a map-side partial aggregate collapses
repeated values before the shuffle, so a value that fills a third of a table
costs one row per task. Numbers, days and instants are grouped as such and
printed afterwards, once a distinct value. Distinct counts, the top
values, sample values and the FK/PK overlap all derive from this one table.

Long values (over ``max_value_chars``) are grouped by a prefix plus their
SHA-256 instead of the whole text, so documents and pages do not flow through
the shuffle. The prefix keeps their order up to ``max_value_chars``
characters; the full texts of those that may make a top-N list, ties in the
prefix included, are fetched back and ranked as they are. Nested values print
ambiguously (``['a, b']`` and ``['a', 'b']``), so they are always grouped by the
digest of their JSON form. A digest key is longer than ``max_value_chars``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import plan_utils as pu
from ..sources.base import quoted, type_class

DIGEST_SEPARATOR = "#"
PAD = "\x00"


def value_string(field: T.StructField) -> Column:
    """String form used for distinctness and matching (values compare as
    strings, so ``1`` and ``1.0`` differ). ``-0.0`` is folded into ``0.0``,
    binary is hex-encoded, and instants print in UTC whatever the session's
    zone is, so the string form of a flat value is one-to-one."""
    return printed(F.col(quoted(field.name)), field.dataType)


def printed(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.FloatType):
        return (c + F.lit(0.0).cast("float")).cast("string")
    if isinstance(dt, T.DoubleType):
        return (c + F.lit(0.0)).cast("string")
    if isinstance(dt, T.BinaryType):
        return F.hex(c)
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, T.TimestampType):
        return _printed_micros(F.unix_micros(c))
    return c.cast("string")


def _printed_micros(micros: Column) -> Column:
    seconds = micros.cast("decimal(26,6)") / F.lit(1_000_000).cast("decimal(7,0)")
    return (F.lit("1970-01-01").cast("timestamp_ntz")
            + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("string")


def value_key(s: Column, field: T.StructField, max_chars: int | None) -> Column:
    """The grouping key of a value that prints as ``s``."""
    digested = lambda what, n: F.concat(
        F.rpad(F.substring(s, 1, n), n, PAD), F.lit(DIGEST_SEPARATOR), F.sha2(what, 256))
    if type_class(field.dataType) == "nested":
        return digested(F.to_json(F.array(F.col(quoted(field.name))), {"ignoreNullFields": "false"}), max_chars or 1)
    if not max_chars or not may_be_long(field):
        return s
    return F.when(F.length(s) > F.lit(max_chars), digested(s, max_chars)).otherwise(s)


def may_be_long(field: T.StructField) -> bool:
    """Numbers, flags, dates and intervals always print short."""
    return type_class(field.dataType) in ("string", "binary", "nested", "other")


def _long_pairs(df: DataFrame, ident: Column, fields, expr) -> DataFrame:
    """Un-pivot ``expr(field)`` of every column to (dataset_id, ordinal, value)."""
    names = [f"v{i}" for i, _ in fields]
    wide = df.select(ident.alias("__id"), *[expr(f).alias(f"v{i}") for i, f in fields])
    long = wide.unpivot(["__id"], names, "var", "value")
    return long.select(F.col("__id").alias("dataset_id"),
                       F.expr("CAST(substring(var, 2) AS INT)").alias("ordinal"),
                       "value")


#: How values are grouped; the printed form of each is one-to-one with what is grouped.
TEXT, WHOLE, DAY, INSTANT, DOUBLE, FLOAT = range(6)
KINDS = 8


def grouped_as(field: T.StructField, max_chars: int | None) -> tuple[int, Column]:
    """The kind of a field's values and the number or text they are grouped by."""
    c, dt = F.col(quoted(field.name)), field.dataType
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return WHOLE, c.cast("long")
    if isinstance(dt, T.DateType):
        return DAY, F.unix_date(c).cast("long")
    if isinstance(dt, T.TimestampType):
        return INSTANT, F.unix_micros(c)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return (DOUBLE if isinstance(dt, T.DoubleType) else FLOAT), c.cast("double")
    return TEXT, value_key(value_string(field), field, max_chars)


def _typed_pairs(df: DataFrame, ident: Column, fields, max_chars: int | None) -> DataFrame:
    """Un-pivot every column to (dataset_id, code, whole, fraction, text): the code tells
    the ordinal and the kind, the value stands in one of the other three, unprinted."""
    columns = [ident.alias("__id"), F.lit(None).cast("long").alias("l"), F.lit(None).cast("double").alias("d"),
               F.lit(None).cast("string").alias("t")]
    places = []
    for i, f in fields:
        kind, value = grouped_as(f, max_chars)
        columns += [F.lit(i * KINDS + kind).alias(f"c{i}"), value.alias(f"v{i}")]
        at = 2 if kind == TEXT else 1 if kind in (DOUBLE, FLOAT) else 0
        places.append(f"(c{i}, " + ", ".join(f"v{i}" if k == at else empty for k, empty in enumerate("ldt")) + ")")
    return df.sparkSession.sql(
        "SELECT __id AS dataset_id, code, whole, fraction, text FROM {wide} UNPIVOT INCLUDE NULLS "
        f"((code, whole, fraction, text) FOR place IN ({', '.join(places)}))", wide=df.select(*columns))


def _printed_key() -> Column:
    """The key of a grouped value of :func:`_typed_pairs`."""
    kind, whole, fraction = F.col("code") % KINDS, F.col("whole"), F.col("fraction") + F.lit(0.0)
    return (F.when(kind == TEXT, F.col("text")).when(kind == WHOLE, whole.cast("string"))
            .when(kind == DAY, F.date_from_unix_date(whole.cast("int")).cast("string"))
            .when(kind == INSTANT, _printed_micros(whole))
            .when(kind == DOUBLE, fraction.cast("string")).otherwise(fraction.cast("float").cast("string")))


def spread(estate, scan) -> DataFrame:
    """With the ``spread_min_rows`` option, a dataset of as many rows (one
    unsplittable file, a single-connection read) is dealt round-robin to the
    cores before the per-value work; otherwise it is left as read."""
    least = estate.options.spread_min_rows
    if least is None or scan.single is None or estate.row_count(scan.single) < least:
        return scan.frame
    return scan.frame.repartition(estate.spark.sparkContext.defaultParallelism)


def column_values(estate, max_chars: int | None = 128, datasets=None, unique: frozenset = frozenset()) -> DataFrame:
    """(dataset_id, ordinal, key, n) for every column of every dataset. Columns
    of ``unique`` (dataset_id, ordinal) are known to hold no value twice: their
    rows are not grouped and do not go through the shuffle."""
    grouped, single = [], []
    for scan in estate.scans(datasets):
        fields = list(enumerate(scan.fields))
        once = [(i, f) for i, f in fields if scan.single and (scan.single.dataset_id, i) in unique]
        df = spread(estate, scan)
        if rest := [x for x in fields if x not in once]:
            grouped.append(_typed_pairs(df, scan.ident, rest, max_chars))
        if once:
            single.append(_long_pairs(df, scan.ident, once, lambda f: value_key(value_string(f), f, max_chars)))
    empty = estate.spark.createDataFrame([], "dataset_id int, ordinal int, key string, n long")
    # numbers, days and instants are grouped as such: only distinct values are printed
    out = (reduce(DataFrame.unionAll, grouped).groupBy("dataset_id", "code", "whole", "fraction", "text")
           .agg(F.count(F.lit(1)).alias("n"))
           .select("dataset_id", F.expr(f"code div {KINDS}").cast("int").alias("ordinal"), _printed_key().alias("key"), "n")
           if grouped else empty)
    if single:
        out = out.unionAll(reduce(DataFrame.unionAll, single).select("dataset_id", "ordinal", "value", F.lit(1).cast("long")))
    return out


def long_values(estate, wanted: DataFrame, max_chars: int | None,
                datasets=None) -> DataFrame | None:
    """One re-read of the text-like columns: (dataset_id, ordinal, key, full)
    with the text of each wanted digest key. A key's texts are all the same,
    so any of them does; no text is sorted. The wanted keys are the top-N
    survivors, N to a column but for ties in the prefix."""
    frames = []
    for scan in estate.scans(datasets):
        fields = [(i, f) for i, f in enumerate(scan.fields) if may_be_long(f)]
        if fields:
            frames.append(_long_pairs(
                spread(estate, scan), scan.ident, fields,
                lambda f: F.struct(value_key(value_string(f), f, max_chars).alias("key"),
                                   value_string(f).alias("full"))))
    if not frames:
        return None
    longs = (reduce(DataFrame.unionAll, frames)
             .select("dataset_id", "ordinal", "value.key", "value.full")
             .filter(F.length("key") > F.lit(max_chars or 1)))
    tags = wanted.select("dataset_id", "ordinal", "key").filter(F.length("key") > F.lit(max_chars or 1)).distinct()
    return (longs.join(pu.small(tags, tags.count()), ["dataset_id", "ordinal", "key"], "left_semi")
            .groupBy("dataset_id", "ordinal", "key").agg(F.any_value("full").alias("full")))


def with_full_values(keyed: DataFrame, longs: DataFrame | None) -> DataFrame:
    """Add ``value``: the key itself, or the full text of a digest key."""
    if longs is None:
        return keyed.withColumn("value", F.col("key"))
    texts = longs.select("dataset_id", "ordinal", "key", F.col("full").alias("__full"))
    return (keyed.join(texts, ["dataset_id", "ordinal", "key"], "left")
            .withColumn("value", F.coalesce("__full", "key")).drop("__full"))
