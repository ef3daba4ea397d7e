"""Discovery entry: volumes then JDBC sources, as one estate of datasets."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import plan_utils as pu
from ..config import SAMPLE_SEED, Options
from .base import Dataset, type_class
from .files import discover_volumes, file_counts, file_row_counts, read_dataset, read_group
from .jdbc import discover_jdbc, jdbc_row_counts, read_jdbc

COLUMNS_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.IntegerType(), False),
    T.StructField("source_type", T.StringType(), False),
    T.StructField("source_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("dtype", T.StringType(), False),
    T.StructField("type_class", T.StringType(), False),
])

DATASETS_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.IntegerType(), False),
    T.StructField("source_type", T.StringType(), False),
    T.StructField("source_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("location", T.StringType(), False),
    T.StructField("format", T.StringType(), False),
    T.StructField("columns", T.ArrayType(T.StringType(), False), False),
    T.StructField("raw_schema", T.MapType(T.StringType(), T.StringType(), False), False),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType(), False), False),
])


@dataclass(eq=False)
class Scan:
    """One relation of a plan: a dataset, or all file datasets of one schema."""

    datasets: list[Dataset]
    frame: DataFrame
    ident: Column               # the dataset_id of a row

    @property
    def fields(self) -> list[T.StructField]:
        return self.datasets[0].schema.fields

    @property
    def single(self) -> Dataset | None:
        return self.datasets[0] if len(self.datasets) == 1 else None


class Estate:
    """The discovered datasets of one run, with lazy frames over them."""

    def __init__(self, spark: SparkSession, datasets: list[Dataset],
                 warnings: list[tuple[str, str]], options: Options):
        self.spark = spark
        self.datasets = datasets
        self.warnings = warnings
        self.options = options
        self._counts: DataFrame | None = None
        self._count_map: dict[int, int] | None = None
        self._files: DataFrame | None = None
        self.scratch = f"estate-{uuid.uuid4().hex[:12]}"

    # -- metadata ---------------------------------------------------------
    @property
    def column_count(self) -> int:
        return sum(len(ds.schema.fields) for ds in self.datasets)

    def columns(self) -> DataFrame:
        """One row per column (metadata: bounded by the schemas' width)."""
        rows = [(ds.dataset_id, ds.source_type, ds.source_name, ds.table_name, i, f.name,
                 str(f.dataType), type_class(f.dataType))
                for ds in self.datasets for i, f in enumerate(ds.schema.fields)]
        return self.spark.createDataFrame(rows, COLUMNS_SCHEMA)

    def datasets_frame(self) -> DataFrame:
        rows = [(ds.dataset_id, ds.source_type, ds.source_name, ds.table_name, ds.location,
                 ds.format, ds.columns, {f.name: str(f.dataType) for f in ds.schema.fields},
                 dict(ds.extra)) for ds in self.datasets]
        return self.spark.createDataFrame(rows, DATASETS_SCHEMA)

    def without(self, ids: set[int]) -> "Estate":
        """The estate but for the datasets of those numbers."""
        rest = Estate(self.spark, [d for d in self.datasets if d.dataset_id not in ids], self.warnings, self.options)
        rest.scratch, rest._files, rest._counts, rest._count_map = self.scratch, self._files, self._counts, self._count_map
        return rest

    def countable(self) -> "Estate":
        """The estate without the datasets that cannot be counted, each a warning;
        found by halving. Looked for only after the count over all has failed."""
        count = lambda some: pu.materialize(Estate(self.spark, some, [], self.options).row_counts(),
                                            self.spark, self.scratch, "counts")
        parts, lost = pu.isolated(self.datasets, count)
        kept = Estate(self.spark, [ds for some, _ in parts for ds in some],
                      self.warnings + [(ds.location, message) for ds, message in lost], self.options)
        if parts:
            kept._counts = reduce(DataFrame.unionByName, [df for _, df in parts])
        return kept

    def release(self) -> None:
        """Delete what this estate has written for itself."""
        pu.remove_scratch(self.spark, self.scratch)
        self._files = None

    # -- data -------------------------------------------------------------
    def row_counts(self) -> DataFrame:
        """(dataset_id, row_count), counted by Spark: one job per file format
        and a ``COUNT(*)`` pushed to each JDBC database."""
        if self._counts is None:
            frames = [f for f in (file_row_counts(self.spark, self.datasets),
                                  jdbc_row_counts(self.spark, self.datasets),
                                  _frame_row_counts(self.datasets)) if f is not None]
            self._counts = reduce(DataFrame.unionByName, frames)
        return self._counts

    def inventory(self) -> DataFrame:
        return self.datasets_frame().join(self.row_counts(), "dataset_id", "left")

    def row_count(self, ds: Dataset) -> int:
        if self._count_map is None:  # one number per dataset: metadata
            self._count_map = {r[0]: r[1] for r in self.row_counts().collect()}
        return self._count_map.get(ds.dataset_id, 0)

    def load(self, ds: Dataset) -> DataFrame:
        """The dataset as a frame; a Bernoulli sample (seed 42) of about
        ``sample_rows`` rows when that option is set and the table is larger."""
        if ds.source_type == "frame":
            df = ds.reader["frame"]
        elif ds.source_type == "jdbc":
            df = read_jdbc(self.spark, ds)
        else:
            df = read_dataset(self.spark, ds)
        if self._sampled(ds):
            fraction = self.options.sample_rows / self.row_count(ds)
            df = df.sample(withReplacement=False, fraction=fraction, seed=SAMPLE_SEED)
        return df

    def _sampled(self, ds: Dataset) -> bool:
        return bool(self.options.sample_rows) and self.row_count(ds) > self.options.sample_rows

    def _files_of(self) -> DataFrame:
        """(file_path, dataset_id, rows) as a table, written once."""
        if self._files is None:
            self._files = pu.materialize(file_counts(self.spark, self.datasets), self.spark, self.scratch, "files")
        return self._files

    def scans(self, datasets=None) -> list[Scan]:
        """The relations that together hold ``datasets`` (all by default) that have
        columns: file datasets of one format and schema are one relation, so that
        a plan has a branch for each schema and not for each file."""
        groups: dict[tuple, list[Dataset]] = {}
        for ds in self.datasets if datasets is None else datasets:
            if not ds.schema.fields:
                continue
            alone = ds.source_type != "volume" or ds.reader.get("base") or self._sampled(ds)
            key = ((ds.dataset_id,) if alone else
                   (ds.format, *((f.name, f.dataType.json()) for f in ds.schema.fields)))
            groups.setdefault(key, []).append(ds)
        out = []
        for group in groups.values():
            if len(group) == 1:
                out.append(Scan(group, self.load(group[0]), F.lit(group[0].dataset_id)))
            else:
                files = sum(len(ds.reader["paths"]) for ds in group)
                ids = [ds.dataset_id for ds in group]
                mine = self._files_of().filter(F.col("dataset_id").between(min(ids), max(ids)))
                frame, mark = read_group(self.spark, group, mine, files)
                out.append(Scan(group, frame, F.col(mark)))
        return out


def _frame_row_counts(datasets: list[Dataset]) -> DataFrame | None:
    frames = [ds.reader["frame"].agg(F.count(F.lit(1)).cast("long").alias("row_count"))
              .select(F.lit(ds.dataset_id).alias("dataset_id"), "row_count")
              for ds in datasets if ds.source_type == "frame"]
    return reduce(DataFrame.unionByName, frames) if frames else None


def discover_frames(spark: SparkSession, frames: dict[str, DataFrame],
                    options: Options | None = None, source_name: str = "frames") -> Estate:
    """An estate of DataFrames the caller already has (one dataset each)."""
    datasets = [Dataset(dataset_id=i, source_type="frame", source_name=source_name,
                        table_name=name, location=name, format="frame", schema=df.schema,
                        reader={"frame": df})
                for i, (name, df) in enumerate(frames.items())]
    return Estate(spark, datasets, [], options or Options())


def discover(spark: SparkSession, paths=(), jdbc_sources=(), options: Options | None = None) -> Estate:
    """All volumes first, then all JDBC sources."""
    options = options or Options()
    paths = [paths] if isinstance(paths, str) else list(paths)
    datasets: list[Dataset] = []
    warnings: list[tuple[str, str]] = []
    if paths:
        found, warn = discover_volumes(spark, paths, options.extensions, options.granularity)
        datasets += found
        warnings += warn
    for src in list(jdbc_sources) + list(options.jdbc_sources):
        found, warn = discover_jdbc(spark, src, first_id=len(datasets))
        datasets += found
        warnings += warn
    return Estate(spark, datasets, warnings, options)
