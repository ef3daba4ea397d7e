"""One analysis of an estate: the frequency table and profiles, written once.

Both are used several times (distinct counts, top-N, FK and PK sides of
the overlap join, name and cardinality scores), so they are written as
Parquet under the cluster's checkpoint folder and read back. That cuts the
lineage: a lost executor costs a re-read, not a re-scan and re-shuffle of
every source. Wide estates are processed ``datasets_per_plan`` datasets at a
time so plan size stays bounded.
"""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import plan_utils as pu
from ..operators import cardinality as D
from ..operators import profile as P
from ..operators import relate as R
from ..operators import values as V
from ..sources.files import has_plain_footer


class Analysis:
    def __init__(self, estate, run_id: str | None = None, materialize: bool = True):
        self.estate = estate
        self.spark = estate.spark
        self.options = estate.options
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self.materialize = materialize
        self.failures: list[tuple[str, str]] = []   # (location, message) of datasets that could not be read
        self._lock = threading.Lock()

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        return pu.materialize(df, self.spark, self.run_id, name)

    def _batches(self):
        n = max(1, self.options.datasets_per_plan)
        ds = self.estate.datasets
        return [ds[i:i + n] for i in range(0, len(ds), n)] or [[]]

    def _batched(self, build, name: str, rest: bool = False) -> DataFrame | None:
        """``build(datasets)`` for each batch of datasets, written batch by batch. A
        batch that fails is tried again in halves, down to the dataset that cannot be
        read: that one is left out of the estate and noted, what has been written stays.
        ``rest``: other datasets have been read already."""
        if not self.materialize:
            built = [df for df in map(build, self._batches()) if df is not None]
            return reduce(DataFrame.unionByName, built) if built else None

        def attempt(datasets):
            df = build(datasets)
            return None if df is None else self._keep(df, name)

        frames, lost = [], []
        for batch in self._batches():
            done, bad = pu.isolated(batch, attempt)
            frames += [df for _, df in done if df is not None]
            lost += bad
        if lost and not frames and not rest:
            raise RuntimeError(f"no dataset could be read: {lost[0][1]}")
        if lost:
            with self._lock:
                self.failures += [(ds.location, message) for ds, message in lost]
                self.estate = self.estate.without({ds.dataset_id for ds, _ in lost})
        return reduce(DataFrame.unionByName, frames) if frames else None

    @cached_property
    def unique_columns(self) -> frozenset:
        """(dataset_id, ordinal) of the columns of large datasets that hold no value
        twice. A sketch tells which may; those are counted exactly, by bits and digests
        (:mod:`..operators.cardinality`), and need no grouping of their values."""
        if not self._large:
            return frozenset()
        least = 1 - 4 * P.SKETCH_ERROR
        # at most one row a column
        may = {(r["dataset_id"], r["ordinal"]) for r in self.typed_stats.filter(
            (F.col("rows") > 0) & (F.col("approx_distinct") >= least * F.col("rows"))).select("dataset_id", "ordinal").collect()}
        if not may:
            return frozenset()
        ids = {d for d, _ in may}
        exact = self._batched(lambda b: D.distinct_counts(self.estate, [ds for ds in b if ds.dataset_id in ids], may), "distinct")
        return frozenset((r["dataset_id"], r["ordinal"]) for r in exact.filter("distinct_count = total_rows").collect())

    @property
    def _large(self) -> frozenset:
        return frozenset(ds.dataset_id for ds in self.estate.datasets
                         if ds.reader.get("bytes", 0) >= self.options.lean_min_bytes)

    @cached_property
    def column_values(self) -> DataFrame:
        """(dataset_id, ordinal, key, n)."""
        return self._batched(
            lambda b: V.column_values(self.estate, self.options.max_value_chars, b, self.unique_columns),
            "column_values")

    @cached_property
    def ranked_keys(self) -> DataFrame:
        return self._keep(P.ranked_keys(self.column_values, self.options.sample_values,
                                        self.options.max_value_chars), "ranked")

    @cached_property
    def long_values(self) -> DataFrame | None:
        return self._batched(
            lambda b: V.long_values(self.estate, self.ranked_keys, self.options.max_value_chars, b),
            "long_values")

    @cached_property
    def top_values(self) -> DataFrame:
        # a small join of two written frames, used once: not written itself
        return P.ranked_values(V.with_full_values(self.ranked_keys, self.long_values),
                               self.options.sample_values)

    @cached_property
    def typed_stats(self) -> DataFrame | None:
        return self._batched(lambda b: P.typed_stats(self.estate, b, self._large), "typed_stats")

    @cached_property
    def basics(self) -> DataFrame:
        """Rows, nulls, least, greatest and mean values, without any shuffle of values."""
        return P.basics(self.estate, self.typed_stats)

    def statistics(self, *needs: str) -> DataFrame:
        """Those columns of ``basics`` that ``needs`` (of ``P.STATISTICS``) names; table
        columns that tell nothing of it are not read. Counts alone come from the footers
        where these can be trusted."""
        typed = self.null_counts if needs == ("counts",) else self._batched(
            lambda b: P.typed_stats(self.estate, b, needs=frozenset(needs)), "statistics")
        left_out = [c for need, columns in P.TOLD.items() if need not in needs for c in columns]
        return P.basics(self.estate, typed).drop(*left_out)

    @cached_property
    def null_counts(self) -> DataFrame | None:
        """Rows and known values of every column: from the footers of flat Parquet files,
        from a scan for all else and for files whose footers do not tell."""
        sampled = self.options.sample_rows
        plain = [ds for ds in self.estate.datasets if self.materialize and not sampled and has_plain_footer(ds)]
        done = []
        n = max(1, self.options.datasets_per_plan)
        for i in range(0, len(plain), n):
            told, _ = pu.isolated(plain[i:i + n], lambda some: pu.materialize(
                P.footer_counts(self.estate, some), self.spark, self.run_id, "footers"))
            done += told
        have = {ds.dataset_id for some, _ in done for ds in some}
        scanned = self._batched(lambda b: P.typed_stats(
            self.estate, [ds for ds in b if ds.dataset_id not in have], needs=frozenset({"counts"})), "counts",
            rest=bool(have)) if len(have) < len(self.estate.datasets) else None
        frames = [df for _, df in done]
        if scanned is not None:
            frames.append(scanned.select("dataset_id", "ordinal", "rows", "known"))
        if not frames:
            return None
        both = reduce(DataFrame.unionByName, frames)
        empty = {"min_value": "string", "max_value": "string", "min_num": "double", "max_num": "double", "mean_raw": "double"}
        return both.select("*", *[F.lit(None).cast(t).alias(c) for c, t in empty.items()])

    @cached_property
    def cardinalities(self) -> DataFrame:
        """Rows and exact distinct counts of every column, without its values."""
        counts = self._batched(lambda b: D.distinct_counts(self.estate, b), "cardinalities")
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
        cols = self.estate.columns()
        if counts is None:
            counts = self.spark.createDataFrame([], "dataset_id int, ordinal int, total_rows long, distinct_count long")
        return (cols.join(counts, ["dataset_id", "ordinal"], "left")
                .select("dataset_id", "ordinal", "table_name", "column_name", zero("total_rows").alias("total_rows"),
                        zero("distinct_count").alias("distinct_count"))
                .withColumn("is_unique", (F.col("distinct_count") == F.col("total_rows")) & (F.col("total_rows") > 0)))

    @cached_property
    def profiles(self) -> DataFrame:
        # the long-value re-read and the typed aggregates are independent jobs
        self.ranked_keys
        with ThreadPoolExecutor(max_workers=2) as pool:
            for f in [pool.submit(lambda: self.long_values), pool.submit(lambda: self.typed_stats)]:
                f.result()
        return self._keep(P.profiles(self.estate, self.column_values, self.top_values,
                                     self.typed_stats), "profiles")

    @cached_property
    def candidates(self) -> DataFrame:
        return self._keep(R.candidates(self.estate, self.column_values, self.profiles,
                                       self.options, self.run_id), "candidates")
