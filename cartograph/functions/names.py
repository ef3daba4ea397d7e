"""Column-name similarity: token Jaccard plus an edit ratio."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rounding import py_round, py_round_sql

_SPLIT = r"(?U)[_\s\-]+"


def name_tokens(name: Column) -> Column:
    """``_`` before every capital, lower-case, split on ``_``/space/``-``,
    drop empty parts, as a set (``customerID`` -> customer, i, d)."""
    parts = F.split(F.lower(F.regexp_replace(name, "([A-Z])", "_$1")), _SPLIT)
    return F.array_distinct(F.filter(parts, lambda t: t != F.lit("")))


def token_jaccard(a: Column, b: Column) -> Column:
    ta, tb = name_tokens(a), name_tokens(b)
    union = F.size(F.array_union(ta, tb))
    return F.when(union == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(ta, tb)) / union)


@F.pandas_udf(T.DoubleType())
def difflib_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio of the lower-cased names (order-sensitive).

    Runs on the distinct (fk name, pk name) pairs only: a pair frame with at
    most columns x columns tiny rows, in Arrow batches.
    """
    return pd.Series(
        [difflib.SequenceMatcher(None, x.lower(), y.lower()).ratio()
         for x, y in zip(a, b)], dtype="float64")


def levenshtein_ratio(a: Column, b: Column) -> Column:
    la, lb = F.lower(a), F.lower(b)
    longest = F.greatest(F.length(la), F.length(lb))
    return F.when(longest == 0, F.lit(0.0)).otherwise(
        F.lit(1.0) - F.levenshtein(la, lb) / longest)


def edit_ratio(a: Column, b: Column, edit: str = "difflib") -> Column:
    if edit == "difflib":
        return difflib_ratio(a, b)
    if edit == "levenshtein":
        return levenshtein_ratio(a, b)
    raise ValueError(f"unknown edit measure: {edit!r}")


def name_similarity(a: Column, b: Column, edit: str = "difflib") -> Column:
    return py_round(F.lit(0.5) * token_jaccard(a, b) + F.lit(0.5) * edit_ratio(a, b, edit), 4)


# ---- DuckDB text of the SQL-expressible parts (used by the oracle) ----------

def name_tokens_sql(name: str) -> str:
    parts = (f"string_split_regex(lower(regexp_replace({name}, '([A-Z])', '_\\1', 'g')), "
             f"'[_\\s\\-]+')")
    return f"list_distinct(list_filter({parts}, lambda t: t <> ''))"


def token_jaccard_sql(a: str, b: str) -> str:
    ta, tb = name_tokens_sql(a), name_tokens_sql(b)
    inter = f"len(list_intersect({ta}, {tb}))"
    union = f"(len({ta}) + len({tb}) - {inter})"
    return f"(CASE WHEN {union} = 0 THEN 0.0 ELSE {inter} / {union} END)"


def levenshtein_ratio_sql(a: str, b: str) -> str:
    longest = f"greatest(length(lower({a})), length(lower({b})))"
    return (f"(CASE WHEN {longest} = 0 THEN 0.0 ELSE "
            f"1.0 - levenshtein(lower({a}), lower({b})) / {longest} END)")


def name_similarity_sql(a: str, b: str) -> str:
    return py_round_sql(
        f"CAST(0.5 AS DOUBLE) * {token_jaccard_sql(a, b)} + "
        f"CAST(0.5 AS DOUBLE) * {levenshtein_ratio_sql(a, b)}", 4)
