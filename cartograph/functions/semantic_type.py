"""Rule-based semantic type of a column (first matching rule wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (PATTERN_AMOUNT, PATTERN_DATE, PATTERN_EMAIL, PATTERN_FLAG,
                      PATTERN_GEO, PATTERN_ID, PATTERN_NAME)

RULES = (
    ("identifier", PATTERN_ID, None),
    ("datetime", PATTERN_DATE, "datetime"),
    ("monetary_amount", PATTERN_AMOUNT, None),
    ("label_or_name", PATTERN_NAME, None),
    ("boolean_flag", PATTERN_FLAG, "boolean"),
    ("geographic", PATTERN_GEO, None),
)


def name_regex(alternatives: str, mode: str = "word") -> str:
    """``word``: \\b(...)\\b, where ``_`` is a word character, so snake_case
    parts never match; ``token``: the parts of snake_case names match too."""
    if mode == "word":
        return rf"\b({alternatives})\b"
    if mode == "token":
        return rf"(^|[^a-z0-9])({alternatives})([^a-z0-9]|$)"
    raise ValueError(f"unknown name_match mode: {mode!r}")


def semantic_type(column_name: Column, type_class: Column, samples: Column,
                  is_unique: Column, mode: str = "word") -> Column:
    """CASE chain over the lower-cased name, the type class and the top values.

    ``samples`` is the array of most frequent non-null values (as strings);
    the e-mail rule needs its first three to look like addresses.
    """
    name = F.lower(column_name)
    first3 = F.slice(samples, 1, 3)
    email = (F.size(samples) > 0) & F.forall(first3, lambda v: v.rlike(PATTERN_EMAIL))
    out = F.when(email, F.lit("email"))
    for label, pattern, tclass in RULES:
        cond = name.rlike(name_regex(pattern, mode))
        if tclass is not None:
            cond = cond | (type_class == F.lit(tclass))
        out = out.when(cond, F.lit(label))
    return (out.when((type_class == "string") & is_unique, F.lit("unique_text"))
               .when(type_class == "string", F.lit("categorical_or_text"))
               .when(type_class == "numeric", F.lit("numeric"))
               .when(type_class == "nested", F.lit("nested"))
               .otherwise(F.lit("unknown")))


def semantic_type_sql(name: str, type_class: str, samples: str, is_unique: str,
                      mode: str = "word") -> str:
    """DuckDB text of :func:`semantic_type` (samples is a VARCHAR list)."""
    lname = f"lower({name})"
    first3 = f"{samples}[1:3]"
    email = (f"(len({samples}) > 0 AND len(list_filter({first3}, lambda v: "
             f"NOT regexp_matches(v, '{PATTERN_EMAIL}'))) = 0)")
    parts = [f"WHEN {email} THEN 'email'"]
    for label, pattern, tclass in RULES:
        cond = f"regexp_matches({lname}, '{name_regex(pattern, mode)}')"
        if tclass is not None:
            cond = f"({cond} OR {type_class} = '{tclass}')"
        parts.append(f"WHEN {cond} THEN '{label}'")
    parts += [
        f"WHEN {type_class} = 'string' AND {is_unique} THEN 'unique_text'",
        f"WHEN {type_class} = 'string' THEN 'categorical_or_text'",
        f"WHEN {type_class} = 'numeric' THEN 'numeric'",
        f"WHEN {type_class} = 'nested' THEN 'nested'",
    ]
    return "(CASE " + " ".join(parts) + " ELSE 'unknown' END)"
