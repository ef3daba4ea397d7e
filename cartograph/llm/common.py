"""Spark helpers shared by the operators: tables, folds, shared scratch, components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import plan_utils as pu


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, parts: int):
    """crc32 of the id's decimal text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string")) % parts


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table under the cluster's shared checkpoint folder, read back."""
    return pu.materialize(df, df.sparkSession, "llm", name)


class Scratch:
    """The intermediate tables of one run of an operator, in a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, f"{name}-{uuid.uuid4().hex[:8]}"

    def written(self, df: DataFrame, name: str) -> DataFrame:
        return pu.materialize(df, self.spark, "llm", self.name, name)

    def last(self, df: DataFrame) -> DataFrame:
        """The result, written beside the folder, which is then deleted: nothing that
        the result does not hold stays behind."""
        out = pu.materialize(df, self.spark, "llm", f"{self.name}-result")
        self.drop()
        return out

    def drop(self) -> None:
        pu.remove_scratch(self.spark, "llm", self.name)
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Have shuffle files deleted whose frames nothing refers to any more: Spark's
    cleaner goes by the driver's garbage, which a long driver-side wait may
    leave uncollected while executors' disks fill up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_text(docs: DataFrame, task: Callable[[pa.Array], list[pa.Array]], added: str) -> DataFrame:
    """Columns c0, c1, ... of ``docs`` (by place, so that any names will do) and
    then those of ``added``, which ``task`` makes from a batch's texts."""
    more = T.StructType.fromDDL(added)
    safe = [f"c{i}" for i in range(len(docs.columns))]
    text = docs.columns.index("text")
    kind = T.StructType([T.StructField(n, f.dataType) for n, f in zip(safe, docs.schema.fields)] + list(more.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *task(batch.column(text))], kind.names)

    return docs.toDF(*safe).mapInArrow(run, kind)


def smallest_hashes(rows: DataFrame, counts: dict, label: str, most: int) -> DataFrame:
    """(doc_id) of about ``most`` rows of each label (never more), those with the
    smallest hash of their id. ``counts`` has the rows of each label: a share of
    the hash's range is cut off first, so that the ranking sees few more rows
    than it keeps, however many there are."""
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, (1.2 * most + 100) / n))])
    mark = F.xxhash64("doc_id")
    low = F.pmod(mark, F.lit(1 << 40)) < share[F.col(label)] * float(1 << 40)
    return (rows.where(low).select("doc_id", label, mark.alias("mark"))
            .withColumn("k", F.row_number().over(Window.partitionBy(label).orderBy("mark", "doc_id")))
            .where(F.col("k") <= most).select("doc_id").distinct())


def list_values(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column of numbers, each by itself."""
    flat, off = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[a:b].copy() for a, b in zip(off[:-1], off[1:])]


def grouped(batches: Iterator[pa.RecordBatch], key: tuple, numbers: tuple, other: str,
            read: Callable[[pa.Array], list]) -> Iterator[tuple[tuple, list]]:
    """(key, parts) of every run of rows with one key, over the borders of batches. A part has an
    array for each of ``numbers`` and the list that ``read`` makes of the column ``other``."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in key]
        cols = [batch.column(c).to_numpy() for c in numbers]
        rest = read(batch.column(other))
        fresh = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        for a, b in zip(np.concatenate(([0], fresh)), np.append(fresh, batch.num_rows)):
            mine = tuple(int(k[a]) for k in keys)
            if mine != now and held:
                yield now, held
                held = []
            now = mine
            held.append([*(c[a:b].copy() for c in cols), rest[a:b]])
    if held:
        yield now, held


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(u, v) links -> (u, v) with v the smallest id of u's component, for every
    id that has a link but is not itself the smallest.

    Alternating large-star and small-star steps; each round is written to the
    shared scratch folder, so that lineage stays short and nothing is collected
    but a count and a checksum. Hubs are safe: each step is a partial minimum
    by id and a join whose large partitions Spark may split.
    """
    e = scratch.written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), name)
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = (large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").where("u <> v").distinct())
        e = scratch.written(small, name)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return e
