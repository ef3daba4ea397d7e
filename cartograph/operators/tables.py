"""Result tables that follow their writers' schemas.

Runs of different versions append to the same tables. A writer with columns
that a table lacks adds them (``ALTER TABLE ... ADD COLUMNS``; older rows read
as nulls); a writer without some of its columns leaves nulls there; a column
whose type is narrower than the table's is widened on the way in. Anything else
that differs is refused before a row is written. A folder of files that the
catalog does not know (a new session over an old location) is taken over with
the merged schema of its files instead of being shadowed by the writer's.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.base import quoted

#: Formats whose tables Spark itself keeps; of others the format merges schemas.
FILE_FORMATS = ("parquet", "orc", "json", "csv")
#: Each type holds every value of those after it.
WIDENINGS = {
    T.LongType: (T.IntegerType, T.ShortType, T.ByteType),
    T.IntegerType: (T.ShortType, T.ByteType),
    T.ShortType: (T.ByteType,),
    T.DoubleType: (T.FloatType, T.IntegerType, T.ShortType, T.ByteType),
    T.FloatType: (T.ShortType, T.ByteType),
    T.TimestampNTZType: (T.DateType,),
}
ATTEMPTS = 5


class SchemaConflict(ValueError):
    """Columns that a table cannot take."""


def holds(table: T.DataType, rows: T.DataType) -> bool:
    """Whether every value of type ``rows`` is one of type ``table``."""
    if isinstance(rows, T.NullType):
        return True
    if isinstance(table, T.ArrayType) and isinstance(rows, T.ArrayType):
        return holds(table.elementType, rows.elementType)
    if isinstance(table, T.MapType) and isinstance(rows, T.MapType):
        return holds(table.keyType, rows.keyType) and holds(table.valueType, rows.valueType)
    if isinstance(table, T.StructType) and isinstance(rows, T.StructType):
        return ([f.name for f in table.fields] == [f.name for f in rows.fields]
                and all(holds(a.dataType, b.dataType) for a, b in zip(table.fields, rows.fields)))
    if isinstance(table, T.DecimalType) and isinstance(rows, T.DecimalType):
        return table.scale >= rows.scale and table.precision - table.scale >= rows.precision - rows.scale
    if isinstance(table, T.StringType) and isinstance(rows, T.StringType):
        return True
    return type(table) is type(rows) or type(rows) in WIDENINGS.get(type(table), ())


def _folded(spark: SparkSession):
    exact = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    return (lambda name: name) if exact else str.lower


def additions(spark: SparkSession, table: T.StructType, rows: T.StructType) -> list[T.StructField]:
    """The columns of ``rows`` that ``table`` lacks. A column without a type (all nulls) waits for one."""
    fold = _folded(spark)
    known = {fold(f.name) for f in table.fields}
    return [f for f in rows.fields if fold(f.name) not in known and not isinstance(f.dataType, T.NullType)]


def conflicts(spark: SparkSession, table: T.StructType, rows: T.StructType) -> list[str]:
    fold = _folded(spark)
    kinds = {fold(f.name): f.dataType for f in table.fields}
    return [f"{f.name}: {f.dataType.simpleString()} into {kinds[fold(f.name)].simpleString()}" for f in rows.fields
            if fold(f.name) in kinds and not holds(kinds[fold(f.name)], f.dataType)]


def conform(df: DataFrame, schema: T.StructType, keep_others: bool = False) -> DataFrame:
    """``df`` with the columns of ``schema``, in its order and types; nulls where it has none.
    ``keep_others`` leaves further columns behind them."""
    fold = _folded(df.sparkSession)
    mine = {fold(f.name): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        own = mine.pop(fold(f.name), None)
        c = F.lit(None) if own is None else F.col(quoted(own.name))
        cols.append((c if own is not None and own.dataType == f.dataType else c.cast(f.dataType)).alias(f.name))
    if keep_others:
        cols += [F.col(quoted(f.name)) for f in mine.values()]
    return df.select(*cols)


def add_columns(spark: SparkSession, name: str, fields: list[T.StructField]) -> None:
    kinds = spark._jvm.org.apache.spark.sql.types.DataType
    ddl = ", ".join(f"{quoted(f.name)} {kinds.fromJson(f.dataType.json()).sql()}" for f in fields)
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl})")
    spark.catalog.refreshTable(name)


def _has_files(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def take_over(spark: SparkSession, name: str, table_format: str, path: str) -> None:
    """Make the files under ``path`` the table ``name``, with the merged schema of all of them."""
    schema = spark.read.format(table_format).option("mergeSchema", "true").load(path).schema
    spark.catalog.createTable(name, path=path, source=table_format, schema=schema)


def append(df: DataFrame, name: str, table_format: str, path: str | None = None) -> list[str]:
    """Append ``df`` to the table ``name``, made on first use; the names of the columns added to it.

    Raises :class:`SchemaConflict` (and writes nothing) where a column's type does
    not fit the table's. Two writers that add the same column at once are both
    served: the later one looks at the table again."""
    spark = df.sparkSession
    if table_format not in FILE_FORMATS:
        w = df.write.mode("append").format(table_format).option("mergeSchema", "true")
        (w.option("path", path) if path else w).saveAsTable(name)
        return []
    if not spark.catalog.tableExists(name):
        if path and _has_files(spark, path):
            take_over(spark, name, table_format, path)
        else:
            rows = df.drop(*[quoted(f.name) for f in df.schema.fields if isinstance(f.dataType, T.NullType)])
            w = rows.write.mode("append").format(table_format)
            (w.option("path", path) if path else w).saveAsTable(name)
            return []
    added: list[str] = []
    for attempt in range(ATTEMPTS):
        table = spark.read.table(name).schema
        if bad := conflicts(spark, table, df.schema):
            raise SchemaConflict(f"{name} cannot take {'; '.join(bad)}")
        new = additions(spark, table, df.schema)
        if not new:
            break
        try:
            add_columns(spark, name, new)
            added += [f.name for f in new]
        except AnalysisException:  # another writer was first, or the table takes no columns
            if attempt == ATTEMPTS - 1:
                raise
            spark.catalog.refreshTable(name)
    conform(df, spark.read.table(name).schema).write.mode("append").format(table_format).saveAsTable(name)
    return added
