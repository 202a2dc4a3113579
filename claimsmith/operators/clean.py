"""Cleaning operators C1-C4: raw all-string frames -> typed staging frames.

Each is a single projection (one ``select``), plus the deterministic
per-key de-duplication of W2 for the two reference sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsmith.functions import text as T
from claimsmith.functions.calendar import month_start
from claimsmith.operators.keys import dedup_keep_smallest

DEFAULT_CLAIM_STATUS = "approved"  # fixed value (reference configuration)


def clean_providers(df: DataFrame) -> DataFrame:
    """Ids upper(trim), name trim, type lower(trim); one row per provider."""
    projected = df.select(
        T.upper_key("provider_id").alias("provider_id"),
        T.trimmed("provider_name").alias("provider_name"),
        T.lower_key("provider_type").alias("provider_type"),
        T.upper_key("region_id").alias("region_id"),
    )
    return dedup_keep_smallest(projected, ["provider_id"])


def clean_regions(df: DataFrame) -> DataFrame:
    """Same rules for regions; one row per region."""
    projected = df.select(
        T.upper_key("region_id").alias("region_id"),
        T.trimmed("region_name").alias("region_name"),
        T.lower_key("population_group").alias("population_group"),
    )
    return dedup_keep_smallest(projected, ["region_id"])


def clean_claims_agg(df: DataFrame, default_status: str = DEFAULT_CLAIM_STATUS) -> DataFrame:
    """Normalise, type and clamp monthly claim aggregates (no dedup)."""
    return df.select(
        T.upper_key("provider_id").alias("provider_id"),
        T.upper_key("region_id").alias("region_id"),
        T.lower_key("treatment_category").alias("treatment_category"),
        T.safe_month("claim_month").alias("claim_month"),
        T.positive_count("claim_count").alias("claim_count"),
        T.money_double("total_billed").alias("total_billed"),
        T.money_double("total_reimbursed").alias("total_reimbursed"),
        T.status_with_default("claim_status", default_status).alias("claim_status"),
    )


def clean_prescriptions_agg(df: DataFrame) -> DataFrame:
    """C4: normalise, type and clamp monthly prescription aggregates."""
    return df.select(
        T.upper_key("provider_id").alias("provider_id"),
        T.upper_key("region_id").alias("region_id"),
        T.lower_key("treatment_category").alias("treatment_category"),
        T.safe_month("claim_month").alias("claim_month"),
        T.positive_count("prescription_count").alias("prescription_count"),
        T.non_negative_int("total_quantity").alias("total_quantity"),
    )


def _count_rules(name: str, least: int) -> dict[tuple[str, str], Column]:
    n = T.int_from_text(name)
    beyond = T.beyond_range(name)
    return {(name, "clamped"): ~F.coalesce(n >= least, F.lit(False)) & ~beyond, (name, "beyond_range"): beyond}


def _amount_rules(name: str) -> dict[tuple[str, str], Column]:
    return {(name, "unparsable"): F.col(name).isNotNull() & T.money_decimal(name).isNull()}


def reject_rules(source: str) -> dict[tuple[str, str], Column]:
    """(column, rule) -> condition on a raw row, for every value that cleaning
    changes or drops: ``invalid`` months (no date), ``clamped`` counts (missing,
    no number or too small), counts ``beyond_range`` (null after cleaning) and
    ``unparsable`` amounts (null after cleaning)."""
    month = {("claim_month", "invalid"): month_start(T.safe_month("claim_month")).isNull()}
    if source == "claims":
        return month | _count_rules("claim_count", 1) | _amount_rules("total_billed") | _amount_rules("total_reimbursed")
    if source == "prescriptions":
        return month | _count_rules("prescription_count", 1) | _count_rules("total_quantity", 0)
    return {}


def reject_counts(source: str) -> list[Column]:
    """One named count per rule, for an aggregation or an Observation of the raw rows."""
    return [F.count_if(c).alias(f"{column}:{rule}") for (column, rule), c in reject_rules(source).items()]


def rejected_values(raw: dict[str, DataFrame]) -> DataFrame:
    """(source_name, column_name, rule, rows) of raw sources, each read once;
    every rule has a row, also with a count of 0."""
    out = None
    for source, df in raw.items():
        rows = F.array(*[F.struct(F.lit(source).alias("source_name"), F.lit(column).alias("column_name"),
                                  F.lit(rule).alias("rule"), F.col(f"`{column}:{rule}`").cast("bigint").alias("rows"))
                         for column, rule in reject_rules(source)])
        found = df.agg(*reject_counts(source)).select(F.inline(rows))
        out = found if out is None else out.unionByName(found)
    return out


def null_missing_tokens(df: DataFrame) -> DataFrame:
    """S1 parity with a pandas CSV read: 'NA', 'null', ... become null."""
    return df.select(*[T.null_missing_tokens(c).alias(c) for c in df.columns])


__all__ = [
    "clean_providers",
    "clean_regions",
    "clean_claims_agg",
    "clean_prescriptions_agg",
    "null_missing_tokens",
    "reject_rules",
    "reject_counts",
    "rejected_values",
]
