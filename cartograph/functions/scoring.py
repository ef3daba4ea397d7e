"""Relationship scores, confidence tiers and the evidence text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (FIT_FK_NOT_UNIQUE, FIT_PK_NO_NULLS, FIT_PK_UNIQUE,
                      WEIGHT_CARDINALITY, WEIGHT_NAME, WEIGHT_OVERLAP)
from .rounding import fixed2, fixed2_sql, py_round, py_round_sql


def cardinality_fit(pk_unique: Column, pk_null_rate: Column, fk_unique: Column) -> Column:
    """+0.5 PK unique, +0.25 PK without nulls, +0.25 FK not unique."""
    return (F.when(pk_unique, F.lit(FIT_PK_UNIQUE)).otherwise(F.lit(0.0))
            + F.when(pk_null_rate == 0.0, F.lit(FIT_PK_NO_NULLS)).otherwise(F.lit(0.0))
            + F.when(~fk_unique, F.lit(FIT_FK_NOT_UNIQUE)).otherwise(F.lit(0.0)))


def confidence(overlap: Column, name: Column, card: Column) -> Column:
    return py_round(F.lit(WEIGHT_OVERLAP) * overlap + F.lit(WEIGHT_NAME) * name
                    + F.lit(WEIGHT_CARDINALITY) * card, 4)


def tier(score: Column, auto_accept: float, human_review: float, low_label: str) -> Column:
    return (F.when(score >= F.lit(auto_accept), F.lit("auto_accepted"))
             .when(score >= F.lit(human_review), F.lit("needs_review"))
             .otherwise(F.lit(low_label)))


def evidence(overlap: Column, name: Column, card: Column) -> Column:
    return F.concat(F.lit("overlap="), fixed2(overlap),
                    F.lit(", name_similarity="), fixed2(name),
                    F.lit(", cardinality_fit="), fixed2(card))


# ---- DuckDB text ------------------------------------------------------------

def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def cardinality_fit_sql(pk_unique: str, pk_null_rate: str, fk_unique: str) -> str:
    return (f"((CASE WHEN {pk_unique} THEN {_d(FIT_PK_UNIQUE)} ELSE 0.0 END)"
            f" + (CASE WHEN {pk_null_rate} = 0.0 THEN {_d(FIT_PK_NO_NULLS)} ELSE 0.0 END)"
            f" + (CASE WHEN NOT {fk_unique} THEN {_d(FIT_FK_NOT_UNIQUE)} ELSE 0.0 END))")


def confidence_sql(overlap: str, name: str, card: str) -> str:
    return py_round_sql(f"{_d(WEIGHT_OVERLAP)} * {overlap} + {_d(WEIGHT_NAME)} * {name}"
                        f" + {_d(WEIGHT_CARDINALITY)} * {card}", 4)


def tier_sql(score: str, auto_accept: float, human_review: float, low_label: str) -> str:
    return (f"(CASE WHEN {score} >= {_d(auto_accept)} THEN 'auto_accepted' "
            f"WHEN {score} >= {_d(human_review)} THEN 'needs_review' ELSE '{low_label}' END)")


def evidence_sql(overlap: str, name: str, card: str) -> str:
    return (f"('overlap=' || {fixed2_sql(overlap)} || ', name_similarity=' || {fixed2_sql(name)}"
            f" || ', cardinality_fit=' || {fixed2_sql(card)})")
