"""JDBC discovery: table list, schema probe and a row count pushed to the database."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import Dataset

CATALOG_QUERY = ("SELECT table_schema, table_name FROM information_schema.tables "
                 "WHERE table_type = 'BASE TABLE'")


def _props(src: dict) -> dict:
    missing = [k for k in ("name", "url", "driver") if not src.get(k)]
    if missing:
        raise ValueError(f"JDBC source lacks {', '.join(missing)}: {src.get('name', '?')}")
    props = {"driver": src["driver"]}
    for key in ("user", "password"):
        if src.get(key) is not None:
            props[key] = src[key]
    return props


def explicit_tables(src: dict) -> list[str]:
    """``tables`` as a list or a comma-separated string; blanks dropped."""
    raw = src.get("tables") or []
    if isinstance(raw, str):
        raw = raw.split(",")
    return [t.strip() for t in raw if t and t.strip()]


def catalog_tables(spark: SparkSession, src: dict) -> list[str]:
    """``schema.table`` of every base table the catalog query lists.

    The query is overridable (``catalog_query``, two columns: schema and
    table) for databases without ``information_schema``; ``exclude_schemas``
    drops the database's own tables. A failing query raises.
    """
    query = src.get("catalog_query", CATALOG_QUERY)
    exclude = {s.upper() for s in src.get("exclude_schemas", ())}
    df = spark.read.jdbc(src["url"], f"({query}) cat", properties=_props(src))
    rows = df.collect()  # table names only: catalog metadata
    out = []
    for r in rows:
        schema, table = str(r[0]).strip(), str(r[1]).strip()
        if schema.upper() not in exclude:
            out.append(f"{schema}.{table}")
    return out


def discover_jdbc(spark: SparkSession, src: dict, first_id: int = 0):
    """One dataset per table. The schema comes from Spark's own schema query
    (no dialect-specific ``LIMIT``); the row count is a ``COUNT(*)`` pushed
    to the database and stays a lazy frame. Returns ``(datasets, warnings)``."""
    props = _props(src)
    datasets, warnings = [], []
    try:
        tables = explicit_tables(src) or catalog_tables(spark, src)
    except Exception as exc:
        return [], [(f"{src['name']}:catalog", f"{type(exc).__name__}: {str(exc).splitlines()[0][:300]}")]
    for table in tables:
        try:
            schema = spark.read.jdbc(src["url"], table, properties=props).schema
        except Exception as exc:
            warnings.append((f"{src['name']}:{table}",
                             f"{type(exc).__name__}: {str(exc).splitlines()[0][:300]}"))
            continue
        datasets.append(Dataset(
            dataset_id=first_id + len(datasets), source_type="jdbc", source_name=src["name"],
            table_name=table, location=table, format="jdbc", schema=schema,
            extra={"jdbc_url": src["url"].split("?")[0].split(";")[0], "driver": src["driver"]},
            reader={"url": src["url"], "props": props,
                    "partitioning": src.get("partitioning", {}).get(table)}))
    return datasets, warnings


def read_jdbc(spark: SparkSession, ds: Dataset) -> DataFrame:
    """Full-table scan, split into parallel range reads when the source
    names a partition column (``partitioning[table] = dict(column=...,
    lowerBound=..., upperBound=..., numPartitions=...)``) or predicates."""
    r = ds.reader
    part = r.get("partitioning")
    if part and part.get("predicates"):
        return spark.read.jdbc(r["url"], ds.location, predicates=list(part["predicates"]),
                               properties=r["props"])
    if part:
        return spark.read.jdbc(r["url"], ds.location, column=part["column"],
                               lowerBound=part["lowerBound"], upperBound=part["upperBound"],
                               numPartitions=part["numPartitions"], properties=r["props"])
    return spark.read.jdbc(r["url"], ds.location, properties=r["props"])


def jdbc_row_counts(spark: SparkSession, datasets: list[Dataset]) -> DataFrame | None:
    frames = []
    for ds in datasets:
        if ds.source_type != "jdbc":
            continue
        q = f"(SELECT COUNT(*) AS cnt FROM {ds.location}) q"
        df = spark.read.jdbc(ds.reader["url"], q, properties=ds.reader["props"])
        # some databases upper-case the alias: take the only column
        frames.append(df.select(F.lit(ds.dataset_id).alias("dataset_id"),
                                F.col(df.columns[0]).cast("long").alias("row_count")))
    return reduce(DataFrame.unionByName, frames) if frames else None
