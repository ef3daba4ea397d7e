"""Small string helpers shared by the semantic phase."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cased(ch: Column) -> Column:
    return F.upper(ch) != F.lower(ch)


def py_title(s: Column) -> Column:
    """Python ``str.title()``: a cased character is upper-cased when the one
    before it is not cased, every other one lower-cased (``l2norm`` ->
    ``L2Norm``, unlike ``initcap``)."""
    n = F.length(s)
    chars = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.when(
            _cased(F.substring(s, i, 1))
            & ((i == 1) | ~_cased(F.substring(s, i - 1, 1))),
            F.upper(F.substring(s, i, 1)),
        ).otherwise(F.lower(F.substring(s, i, 1))))
    return F.when(n == 0, F.lit("")).otherwise(F.array_join(chars, ""))


def py_title_sql(s: str) -> str:
    def cased(e: str) -> str:
        return f"(upper({e}) <> lower({e}))"
    ch = f"substr({s}, i, 1)"
    prev = f"substr({s}, i - 1, 1)"
    body = (f"CASE WHEN {cased(ch)} AND (i = 1 OR NOT {cased(prev)}) "
            f"THEN upper({ch}) ELSE lower({ch}) END")
    return (f"(CASE WHEN length({s}) = 0 THEN '' ELSE array_to_string("
            f"list_transform(generate_series(1, length({s})), lambda i: {body}), '') END)")


def py_strip(s: Column) -> Column:
    """``str.strip()`` with Unicode white space."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")
