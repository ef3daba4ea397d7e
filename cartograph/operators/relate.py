"""Foreign-key -> primary-key candidates in one plan over all column pairs.

The per-pair loop of two Spark actions becomes one grouping of the
frequency table on the value (:mod:`.overlap`). Pairs with no common value
never appear, which is exactly the ``overlap < min_overlap`` cut for a
positive cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import plan_utils as pu
from ..config import RELATIONSHIP_TYPE
from ..functions import names as N
from ..functions import scoring as S
from ..functions.rounding import py_round
from . import overlap as O

ALWAYS_EXCLUDED = ("nested",)


def pk_columns(profiles: DataFrame) -> DataFrame:
    """Unique, without nulls, non-empty."""
    return profiles.filter(F.col("pk_candidate") & (F.col("null_count") == 0))


def fk_columns(profiles: DataFrame, options) -> DataFrame:
    """P5 + P6: not a PK, type not excluded; with the ``max_cols_per_table``
    option only among a table's first columns (:func:`left_out_columns` has
    the others)."""
    found = _eligible(profiles, options)
    cap = options.max_cols_per_table
    return found if cap is None else found.filter(F.col("ordinal") < cap)


def left_out_columns(profiles: DataFrame, options) -> DataFrame:
    """The FK columns that the ``max_cols_per_table`` option leaves out."""
    cap = options.max_cols_per_table
    return (_eligible(profiles, options).filter(F.lit(False) if cap is None else F.col("ordinal") >= cap)
            .select("dataset_id", "source_name", "table_name", "ordinal", "column_name"))


def _eligible(profiles: DataFrame, options) -> DataFrame:
    excluded = list(options.fk_excluded_types) + list(ALWAYS_EXCLUDED)
    return profiles.filter(~F.col("pk_candidate") & ~F.col("inferred_type").isin(excluded))


def candidate_pair_counts(profiles: DataFrame, options) -> DataFrame:
    """J2 without enumerating pairs: every FK column pairs with every PK
    column of another dataset, so its pair count is #PK - #PK in its own
    dataset (a scalar subquery plus a grouped count)."""
    pks = pk_columns(profiles)
    total = pks.select(F.count(F.lit(1))).scalar()
    own = pks.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("own_pk"))
    return (fk_columns(profiles, options).join(own, "dataset_id", "left")
            .select("dataset_id", "source_name", "table_name", "ordinal", "column_name",
                    (total - F.coalesce("own_pk", F.lit(0))).cast("long").alias("pk_partners")))


def matched_values(estate, freq: DataFrame, profiles: DataFrame, options) -> DataFrame:
    """(fk_dataset, fk_ordinal, pk_dataset, pk_ordinal, matched) for every
    pair of columns from different datasets sharing at least one value.

    One scan of the frequency table, only of columns that can match, and one
    shuffle on the value; see :mod:`.overlap`."""
    roles = O.can_match(fk_columns(profiles, options), pk_columns(profiles))
    return O.matched_pairs(freq.filter(F.col("key").isNotNull())
                           .join(pu.small(roles, estate.column_count), ["dataset_id", "ordinal"]))


def _side(profiles: DataFrame, prefix: str) -> DataFrame:
    return profiles.select(
        F.col("dataset_id").alias(f"{prefix}_dataset"), F.col("ordinal").alias(f"{prefix}_ordinal"),
        F.col("source_name").alias(f"{prefix}_source"), F.col("table_name").alias(f"{prefix}_table"),
        F.col("column_name").alias(f"{prefix}_col"), F.col("is_unique").alias(f"{prefix}_unique"),
        F.col("null_rate").alias(f"{prefix}_null_rate"),
        (F.col("distinct_count") - F.when(F.col("null_count") > 0, 1).otherwise(0))
        .alias(f"{prefix}_distinct"))


def value_overlap(estate, freq: DataFrame, profiles: DataFrame, options) -> DataFrame:
    """J1 + P8: matched / distinct FK values, rounded to 4, kept when at
    least ``min_overlap``."""
    bound = estate.column_count
    m = matched_values(estate, freq, profiles, options)
    fk, pk = _side(profiles, "fk"), _side(profiles, "pk")
    out = (m.join(pu.small(fk, bound), ["fk_dataset", "fk_ordinal"])
           .join(pu.small(pk, bound), ["pk_dataset", "pk_ordinal"])
           .withColumn("overlap_score",
                       py_round(F.col("matched") / F.nullif(F.col("fk_distinct"), F.lit(0)), 4)))
    return out.filter(F.col("overlap_score") >= F.lit(options.min_overlap))


def candidates(estate, freq: DataFrame, profiles: DataFrame, options, scratch: str | None = None) -> DataFrame:
    """scored, tiered and ordered relationship candidates. The overlaps
    are written under ``scratch`` (a run's own folder, the estate's by default)."""
    # used twice, one row a pair: written once
    ov = pu.materialize(value_overlap(estate, freq, profiles, options), estate.spark, scratch or estate.scratch, "overlap")
    # name similarity on the distinct name pairs only (tiny), then joined back
    names = ov.select("fk_col", "pk_col").distinct().withColumn(
        "name_score", N.name_similarity(F.col("fk_col"), F.col("pk_col"), options.edit))
    scored = (ov.join(names, ["fk_col", "pk_col"])
              .withColumn("cardinality_score",
                          S.cardinality_fit(F.col("pk_unique"), F.col("pk_null_rate"),
                                            F.col("fk_unique"))))
    conf = S.confidence(F.col("overlap_score"), F.col("name_score"), F.col("cardinality_score"))
    scored = scored.withColumn("confidence", conf)
    return scored.select(
        "fk_dataset", "pk_dataset",
        F.concat_ws(".", "fk_source", "fk_table").alias("source_table"),
        F.col("fk_col").alias("source_col"),
        F.concat_ws(".", "pk_source", "pk_table").alias("target_table"),
        F.col("pk_col").alias("target_col"),
        F.col("fk_table").alias("source_table_name"),
        F.col("pk_table").alias("target_table_name"),
        "matched", F.col("fk_distinct").alias("fk_distinct_values"),
        "overlap_score", "name_score", "cardinality_score", "confidence",
        S.tier(F.col("confidence"), options.auto_accept, options.human_review, "discarded")
        .alias("status"),
        S.evidence(F.col("overlap_score"), F.col("name_score"), F.col("cardinality_score"))
        .alias("evidence"),
        F.lit(RELATIONSHIP_TYPE).alias("relationship_type"))


def ordered(cands: DataFrame) -> DataFrame:
    """O1: confidence descending, then a total order on the keys."""
    return cands.orderBy(F.col("confidence").desc(), "source_table", "source_col",
                         "target_table", "target_col")
