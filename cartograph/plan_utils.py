"""Plan helpers: size-checked broadcast and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Frames whose row count is bounded by metadata (columns, datasets, top-N
# lists) are broadcast only while that bound stays under this many rows.
BROADCAST_ROW_LIMIT = 200_000


def small(df: DataFrame, row_bound: int, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` when its proven row bound is small; otherwise leave
    the join strategy to Spark (sort-merge, or AQE's runtime choice)."""
    return F.broadcast(df) if row_bound <= limit else df


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session; a machine-local temporary folder is never used.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for "
                           "intermediate tables")
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([scratch_root(spark), "cartograph", *parts])


def materialize(df: DataFrame, spark: SparkSession, *parts: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, so a lost executor re-reads files instead of
    re-running the scan and shuffle."""
    path = scratch_path(spark, *parts, uuid.uuid4().hex[:8])
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def isolated(items: list, attempt):
    """``attempt`` over all items at once; where that fails, over the halves, and so
    on down to single items: ``([(items, result)], [(item, message)])``. One bad
    item among n costs about log2(n) failed attempts; what has succeeded is kept."""
    done, lost, open_ = [], [], [list(items)] if items else []
    while open_:
        some = open_.pop()
        try:
            done.append((some, attempt(some)))
        except Exception as exc:
            if len(some) == 1:
                lost.append((some[0], f"{type(exc).__name__}: {(str(exc).splitlines() or [''])[0][:300]}"))
            else:
                half = len(some) // 2
                open_ += [some[half:], some[:half]]
    return done, lost


def remove_scratch(spark: SparkSession, *parts: str) -> None:
    """Delete a run's own intermediate tables (by the file system that holds them)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, *parts))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
