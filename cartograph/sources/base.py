"""Dataset descriptors and type classes shared by every phase."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T


@dataclass(eq=False)
class Dataset:
    """One discovered table: a file, a directory of part files or a JDBC table.

    ``dataset_id`` is unique within a run, so two files with the same base
    name in different folders never mix.
    """

    dataset_id: int
    source_type: str            # "volume" | "jdbc"
    source_name: str            # volume root, or JDBC source name
    table_name: str             # file base name, or JDBC table
    location: str               # file / directory URI, or JDBC table
    format: str                 # parquet | csv | json | jdbc
    schema: T.StructType
    extra: dict[str, str] = field(default_factory=dict)
    reader: dict[str, Any] = field(default_factory=dict)   # connection / reader options

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def type_class(dt: T.DataType) -> str:
    """Coarse class of a Spark type, tested on the type, not its name."""
    if isinstance(dt, T.NumericType):
        return "numeric"
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dt, T.BinaryType):
        return "binary"
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return "nested"
    if isinstance(dt, (T.DayTimeIntervalType, T.YearMonthIntervalType,
                       T.CalendarIntervalType)):
        return "interval"
    if isinstance(dt, T.NullType):
        return "null"
    return "other"


def orderable(dt: T.DataType) -> bool:
    """Whether ``min``/``max`` are defined for the type."""
    if isinstance(dt, (T.MapType, T.VariantType, T.CalendarIntervalType)):
        return False
    if isinstance(dt, T.ArrayType):
        return orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(orderable(f.dataType) for f in dt.fields)
    return True


def quoted(name: str) -> str:
    """Back-tick a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"
