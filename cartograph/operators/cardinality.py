"""Exact distinct counts without the values themselves.

A count of distinct values does not need the values in the shuffle:

* whole numbers, dates and instants go by words of 64 neighbours: a row is
  (column, value >> 6) with a bit for each value seen, joined by ``bit_or`` on the
  map side, so that a dense key of n values is n / 64 rows;
* everything else goes by 128 bits of hashes of its printed form, however long
  that is (two of a billion values meet with a chance below 10**-20).

A null counts as a value. Both parts are plain grouped aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.base import quoted, type_class
from . import values as V


def whole_number(field: T.StructField) -> Column | None:
    """A 64-bit whole number that tells the field's values apart, if there is one."""
    c, dt = F.col(quoted(field.name)), field.dataType
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    return None


def _printed(field: T.StructField) -> Column:
    if type_class(field.dataType) == "nested":  # flat text is ambiguous
        whole = F.to_json(F.array(F.col(quoted(field.name))), {"ignoreNullFields": "false"})
        return F.when(F.col(quoted(field.name)).isNotNull(), whole)
    return V.value_string(field)


def _words(df: DataFrame, ident: Column, fields) -> DataFrame:
    wide = df.select(ident.alias("__id"), *[whole_number(f).alias(f"v{i}") for i, f in fields])
    return wide.unpivot(["__id"], [f"v{i}" for i, _ in fields], "var", "value")


def _hashes(df: DataFrame, ident: Column, fields) -> DataFrame:
    def both(f):
        s = _printed(f)
        return F.when(s.isNotNull(), F.struct(F.xxhash64(s).alias("h1"), F.xxhash64(F.lit(1), s).alias("h2")))
    wide = df.select(ident.alias("__id"), *[both(f).alias(f"v{i}") for i, f in fields])
    return wide.unpivot(["__id"], [f"v{i}" for i, _ in fields], "var", "value")


def distinct_counts(estate, datasets=None, only: set | None = None) -> DataFrame:
    """(dataset_id, ordinal, total_rows, non_null, distinct_count) of every column,
    or of those of ``only`` (dataset_id, ordinal). A column of an empty dataset has no row."""
    words, hashes = [], []
    for scan in estate.scans(datasets):
        fields = [(i, f) for i, f in enumerate(scan.fields)
                  if only is None or any((ds.dataset_id, i) in only for ds in scan.datasets)]
        whole = [x for x in fields if whole_number(x[1]) is not None]
        other = [x for x in fields if whole_number(x[1]) is None]
        if whole:
            words.append(_words(scan.frame, scan.ident, whole))
        if other:
            hashes.append(_hashes(scan.frame, scan.ident, other))
    column = [F.col("__id").alias("dataset_id"), F.expr("CAST(substring(var, 2) AS INT)").alias("ordinal")]
    parts = []
    if words:
        v = F.col("value")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), v.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        parts.append(reduce(DataFrame.unionAll, words)
                     .select(*column, F.shiftright(v, 6).alias("word"), bit.alias("bit"))
                     .groupBy("dataset_id", "ordinal", "word").agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))
                     .select("dataset_id", "ordinal", "n", F.col("word").isNotNull().alias("known"),
                             F.coalesce(F.bit_count("bits"), F.lit(1)).alias("values")))
    if hashes:
        parts.append(reduce(DataFrame.unionAll, hashes).select(*column, "value.h1", "value.h2")
                     .groupBy("dataset_id", "ordinal", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
                     .select("dataset_id", "ordinal", "n", F.col("h1").isNotNull().alias("known"), F.lit(1).alias("values")))
    if not parts:
        return estate.spark.createDataFrame([], "dataset_id int, ordinal int, total_rows long, non_null long, distinct_count long")
    out = reduce(DataFrame.unionAll, parts).groupBy("dataset_id", "ordinal").agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).cast("long").alias("non_null"),
        F.sum("values").cast("long").alias("distinct_count"))
    return out if only is None else out.filter(F.concat_ws(":", "dataset_id", "ordinal").isin(
        [f"{d}:{o}" for d, o in sorted(only)]))
