"""Event synthesis D1-D13: monthly aggregates -> pseudonymous events.

Expansion (D1) is skew-safe: an aggregate row with count n is first split
into ceil(n / CHUNK) chunk rows, the chunk rows are spread over the
cluster by a hash of (row key, chunk), and only then exploded. A single
aggregate row of a billion events therefore becomes many tasks instead of
one, and the sha256 work runs everywhere.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsmith.functions import calendar as C
from claimsmith.functions import hashing as H
from claimsmith.functions import money as M
from claimsmith.operators.keys import add_surrogate_key, bounded_broadcast

# Fixed values (reference configuration).
DEFAULT_SEED = 20260308
DEFAULT_VISIT_THRESHOLD = 3

EXPAND_CHUNK = 8192
ROWS_PER_EXPAND_PARTITION = 2_000_000


def _expand_partitions(agg: DataFrame, count_col: str) -> int:
    """Partition count for the expansion: one small action on the aggregate
    table (a single number), never on the events."""
    spark = agg.sparkSession
    total = agg.select(F.sum(F.col(count_col).cast("bigint"))).first()[0] or 0
    base = spark.sparkContext.defaultParallelism
    return max(1, base, math.ceil(total / ROWS_PER_EXPAND_PARTITION))


def expand_by_count(agg: DataFrame, count_col: str, key_col: str, seq_col: str = "seq",
                    num_partitions: int | None = None) -> DataFrame:
    """One output row per 1..n of ``count_col`` (n >= 1 after the clamp).

    ``sequence(1, n)`` descends when n < 1 (``[1, 0]``), which is why the
    cleaners clamp counts to >= 1 first; this operator keeps that contract.
    """
    n = F.col(count_col)
    parts = num_partitions or _expand_partitions(agg, count_col)
    chunk = F.lit(EXPAND_CHUNK)
    chunks = agg.withColumn("__chunk", F.explode(F.sequence(F.lit(0), M.int_div(n - 1, chunk))))
    spread = chunks.repartition(parts, F.col(key_col), F.col("__chunk"))
    lo = F.col("__chunk") * chunk + 1
    hi = F.least(n, (F.col("__chunk") + 1) * chunk)
    return spread.withColumn(seq_col, F.explode(F.sequence(lo.cast("bigint"), hi.cast("bigint")))).drop("__chunk")


def synthesize_claim_events(claims_agg: DataFrame, seed: int = DEFAULT_SEED,
                            num_partitions: int | None = None) -> DataFrame:
    """Claim events from cleaned claim aggregates (stg_claims_agg).

    Everything that depends only on the aggregate row (key, category id,
    month start, totals in cents) is computed once per aggregate row, before
    the expansion; per event only the ids, the day and the split remain.
    """
    keyed = claims_agg.select(
        "*",
        H.source_row_key("provider_id", "region_id", "treatment_category", "claim_month",
                         "claim_status").alias("source_row_key"),
        H.category_id("treatment_category").alias("__treatment_id"),
        C.month_start("claim_month").alias("__month_start"),
        M.to_cents("total_billed").alias("__billed_c"),
        M.to_cents("total_reimbursed").alias("__reimb_c"),
    )
    ev = expand_by_count(keyed, "claim_count", "source_row_key", num_partitions=num_partitions)
    n, seq = F.col("claim_count"), F.col("seq")
    billed_c = M.allocate_cents(F.col("__billed_c"), n, seq, M.floor_div_cents)
    reimb_c = M.allocate_cents(F.col("__reimb_c"), n, seq, M.floor_div_cents)
    return ev.select(
        H.keyed_id(seed, "claim", "source_row_key", "seq").alias("claim_id"),
        H.keyed_id(seed, "patient", "source_row_key", "seq").alias("patient_id"),
        "provider_id",
        "region_id",
        F.col("__treatment_id").alias("treatment_id"),
        "treatment_category",
        C.day_in_spread("__month_start", "seq").alias("claim_date"),
        M.cents_to_double(billed_c).alias("billed_amount"),
        M.cents_to_double(M.cap_at(reimb_c, billed_c)).alias("reimbursed_amount"),
        "claim_status",
        "source_row_key",
    )


def synthesize_prescription_events(prescriptions_agg: DataFrame, seed: int = DEFAULT_SEED,
                                   num_partitions: int | None = None) -> DataFrame:
    """Prescription events; the key has no status (so patients never meet
    claim patients, as in the reference)."""
    keyed = prescriptions_agg.select(
        "*",
        H.source_row_key("provider_id", "region_id", "treatment_category", "claim_month").alias("source_row_key"),
        H.category_id("treatment_category").alias("__treatment_id"),
        C.month_start("claim_month").alias("__month_start"),
    )
    ev = expand_by_count(keyed, "prescription_count", "source_row_key", num_partitions=num_partitions)
    n, seq = F.col("prescription_count"), F.col("seq")
    return ev.select(
        H.keyed_id(seed, "prescription", "source_row_key", "seq").alias("prescription_id"),
        H.keyed_id(seed, "patient", "source_row_key", "seq").alias("patient_id"),
        "provider_id",
        "region_id",
        F.col("__treatment_id").alias("treatment_id"),
        "treatment_category",
        C.day_in_spread("__month_start", "seq").alias("prescription_date"),
        M.allocate_integer(F.col("total_quantity"), n, seq).cast("bigint").alias("quantity"),
        "source_row_key",
    )


def known_providers(providers: DataFrame) -> DataFrame:
    """Providers to look up by id, broadcast behind the size check: a few
    providers hold all events, which a sort-merge join would sort in as many
    tasks as there are providers."""
    return bounded_broadcast(providers, providers.count())


def patient_regions(claim_events: DataFrame, prescription_events: DataFrame, providers: DataFrame) -> DataFrame:
    """U3 + J1 + A2: one row per patient with the (smallest) known provider
    region. ``min`` is a partial aggregate, so a patient id shared by a third
    of all events is combined map-side. It runs over the rank of the region,
    a number, so that the events are aggregated by hash and never sorted; the
    few regions are ranked once and looked up again at the end."""
    ranked = add_surrogate_key(providers.select("region_id").where("region_id is not null").distinct(), "__rank",
                               ["region_id"])
    regions = bounded_broadcast(ranked, ranked.cs_row_count)
    located = known_providers(providers.select("provider_id", "region_id").join(regions, "region_id", "left").select(
        "provider_id", "__rank"))
    pairs = claim_events.select("patient_id", "provider_id").unionByName(
        prescription_events.select("patient_id", "provider_id")
    )
    # The (patient, provider) distinct of the reference is subsumed by min().
    with_region = pairs.join(located, "provider_id", "left")
    least = with_region.groupBy("patient_id").agg(F.min("__rank").alias("__rank"))
    return least.join(regions, "__rank", "left").select("patient_id", "region_id")


def synthesize_patients(claim_events: DataFrame, prescription_events: DataFrame, providers: DataFrame) -> DataFrame:
    """D11 + D12: patient rows with hash-derived attributes; region falls back
    to R11 when the provider is unknown."""
    regions = patient_regions(claim_events, prescription_events, providers)
    attrs = H.patient_attributes("patient_id")
    return regions.select(
        "patient_id",
        attrs["birth_date"].alias("birth_date"),
        attrs["gender"].alias("gender"),
        F.coalesce(F.col("region_id"), F.lit(H.FALLBACK_REGION_ID)).alias("region_id"),
        attrs["registration_date"].alias("registration_date"),
    )


def visit_candidates(claim_events: DataFrame, providers: DataFrame, seed: int, threshold: int) -> DataFrame:
    """J2 + F5-F7: claims at hospital-like providers, or picked by hash."""
    with_type = claim_events.join(known_providers(providers.select("provider_id", "provider_type")), "provider_id", "left")
    keep = H.hospital_like("provider_type") | H.hash_sample("claim_id", seed, threshold)
    return with_type.filter(keep)


def synthesize_visits(claim_events: DataFrame, providers: DataFrame, seed: int = DEFAULT_SEED,
                      threshold: int = DEFAULT_VISIT_THRESHOLD) -> DataFrame:
    """Visit events derived from claims."""
    picked = visit_candidates(claim_events, providers, seed, threshold)
    return picked.select(
        H.keyed_id(seed, "visit", "claim_id").alias("visit_id"),
        "patient_id",
        "provider_id",
        "region_id",
        "treatment_id",
        F.col("claim_date").alias("admission_date"),
        F.date_add(F.col("claim_date"), H.discharge_offset("claim_id")).alias("discharge_date"),
        H.diagnosis_code("patient_id").alias("diagnosis_code"),
        "claim_id",
    )

