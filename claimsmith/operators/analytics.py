"""Analytics queries N1-N5 and the brief's declared reports X1-X6.

All money is summed in integer cents and rounded with exact integer
arithmetic, so totals do not depend on partitioning or summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsmith.functions import money as M
from claimsmith.operators.keys import group_row_number, hash_slices, hashed_lookup
from claimsmith.sources.io import materialize

# Fixed values (reference notebook parameters).
HIGH_RATIO_THRESHOLD = 0.95
TOP_PROVIDERS = 20
# Events of a patient up to which one task numbers them all.
WHOLE_JOURNEY = 500_000
DUPLICATE_KEYS = ("patient_sk", "provider_sk", "treatment_sk", "date_sk")
# What the per-claim report reads of a claim line.
FEATURE_INPUTS = ("claim_id", *DUPLICATE_KEYS, "billed_amount", "reimbursed_amount")
# Averages of double ratios are reported to 10 decimals so that they do not
# depend on the order in which partitions are summed.
AVG_RATIO_DECIMALS = 10


def monthly_cents(fact_reimbursements: DataFrame, dim_date: DataFrame) -> DataFrame:
    """J7 + A5 core: cents totals per (year, month) of the curated tables."""
    joined = fact_reimbursements.join(dim_date.select("date_sk", "year", "month"), "date_sk", "inner")
    return joined.groupBy("year", "month").agg(
        F.sum("total_claims").cast("bigint").alias("claims_volume"),
        F.sum(M.to_cents("total_billed")).alias("billed_cents"),
        F.sum(M.to_cents("total_reimbursed")).alias("reimbursed_cents"),
    )


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """A5 core from sums per date (``star.daily_cents``). J7 is an identity
    here: the date key tells its year and month, and dim_date has every date
    that occurs, so the join would drop rows without a date and nothing else."""
    date = F.col("date_sk")
    return daily.where(date.isNotNull()).groupBy(
        M.int_div(date, F.lit(10000)).cast("int").alias("year"),
        F.pmod(M.int_div(date, F.lit(100)), F.lit(100)).cast("int").alias("month"),
    ).agg(
        F.sum("total_claims").cast("bigint").alias("claims_volume"),
        F.sum("billed_cents").alias("billed_cents"), F.sum("reimbursed_cents").alias("reimbursed_cents"))


def kpi_rows(monthly: DataFrame) -> DataFrame:
    """A5: totals (2 dp) and rate (4 dp, half-up, null when billed is 0), ordered by year, month."""
    return monthly.select(
        "year", "month", "claims_volume",
        M.cents_to_double("billed_cents").alias("billed_total"),
        M.cents_to_double("reimbursed_cents").alias("reimbursed_total"),
        M.round_half_up_ratio(F.col("reimbursed_cents"), F.col("billed_cents"), 4).alias("reimbursement_rate"),
    ).orderBy("year", "month")


def kpi_rows_unrounded(monthly: DataFrame) -> DataFrame:
    """The notebook form; unrounded rate, x/0 -> null (pandas gives inf/NaN)."""
    billed = M.cents_to_double("billed_cents")
    reimb = M.cents_to_double("reimbursed_cents")
    return monthly.select(
        "year", "month", "claims_volume",
        billed.alias("billed_total"),
        reimb.alias("reimbursed_total"),
        F.when(F.col("billed_cents") != 0, reimb / billed).alias("reimbursement_rate"),
    ).orderBy("year", "month")


def claims_kpi(fact_reimbursements: DataFrame, dim_date: DataFrame) -> DataFrame:
    """N1 (flagship) over the curated tables."""
    return kpi_rows(monthly_cents(fact_reimbursements, dim_date))


def claims_kpi_unrounded(fact_reimbursements: DataFrame, dim_date: DataFrame) -> DataFrame:
    """N2 over the curated tables."""
    return kpi_rows_unrounded(monthly_cents(fact_reimbursements, dim_date))


def claim_anomaly_features(fact_claims: DataFrame) -> DataFrame:
    """N3 + W3: per-claim ratio, high-ratio flag and duplicate-pattern flag.

    The duplicate flag (pandas ``duplicated(keep=False)`` on four keys, nulls
    equal) comes from a partial count per key, not a window: a pattern shared
    by a third of all claims is combined map-side. Only patterns that occur
    more than once are joined back. They are written and counted first, so
    that the claims are not shuffled to meet a few of them; many are hashed by
    partition, where AQE splits a skewed pattern.
    """
    base = _with_ratio(fact_claims)
    repeated = base.groupBy(*DUPLICATE_KEYS).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(
        *[F.col(k).alias(f"__k_{k}") for k in DUPLICATE_KEYS], "__n")
    repeated = materialize(repeated, "repeated_patterns")
    repeated = hashed_lookup(repeated, repeated.count())
    cond = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in DUPLICATE_KEYS]
    return base.join(repeated, cond, "left").select(
        "claim_id", *DUPLICATE_KEYS, "billed_amount", "reimbursed_amount", "reimbursement_ratio", "is_high_ratio",
        F.col("__n").isNotNull().cast("int").alias("is_potential_duplicate"),
    )


def _with_ratio(fact_claims: DataFrame) -> DataFrame:
    """Reimbursed / billed (0 when nothing was billed) and its flag."""
    b, r = F.col("billed_amount"), F.col("reimbursed_amount")
    ratio = F.when(b == 0, F.lit(0.0)).otherwise(r / b)
    return fact_claims.select(
        "claim_id", *DUPLICATE_KEYS, "billed_amount", "reimbursed_amount", ratio.alias("reimbursement_ratio"),
        F.coalesce(ratio > HIGH_RATIO_THRESHOLD, F.lit(False)).cast("int").alias("is_high_ratio"))


def provider_features(fact_claims: DataFrame) -> DataFrame:
    """Per provider (null providers dropped, as pandas groupby does).

    A pattern belongs to one provider, so the claims are summed per pattern
    first and the patterns per provider: two partial aggregations, no join.
    """
    ratio = F.col("reimbursement_ratio")
    patterns = _with_ratio(fact_claims).where("provider_sk is not null").groupBy(*DUPLICATE_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count("claim_id").alias("ids"), F.sum(ratio).alias("ratios"),
        F.count(ratio).alias("ratio_n"), F.sum("is_high_ratio").alias("high"))
    return patterns.groupBy("provider_sk").agg(
        F.sum("ids").cast("bigint").alias("claims_count"),
        F.round(F.try_divide(F.sum("ratios"), F.sum("ratio_n")), AVG_RATIO_DECIMALS).alias("avg_reimbursement_ratio"),
        F.sum("high").cast("bigint").alias("high_ratio_count"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).cast("bigint").alias("duplicate_pattern_count"),
    )


def provider_anomaly_ranking(fact_claims: DataFrame, top: int = TOP_PROVIDERS) -> DataFrame:
    """N4 + O2: top providers by high-ratio then duplicate counts (provider_sk
    breaks ties). orderBy+limit plans as TakeOrderedAndProject: each task keeps
    only its top rows."""
    return provider_features(fact_claims).orderBy(
        F.col("high_ratio_count").desc(), F.col("duplicate_pattern_count").desc(), F.col("provider_sk").asc()
    ).limit(top)


def provider_snapshot(fact_claims: DataFrame) -> DataFrame:
    """Claim events, unique patients, rejections and averages per
    provider (averages half-up to the cent), most claims first."""
    agg = fact_claims.groupBy("provider_sk").agg(
        F.count(F.lit(1)).cast("bigint").alias("claim_events"),
        F.countDistinct("patient_sk").cast("bigint").alias("unique_patients"),
        F.sum(F.when(F.col("claim_status") == "rejected", 1).otherwise(0)).cast("bigint").alias("rejected_claims"),
        F.sum(M.to_cents("billed_amount")).alias("__billed_c"),
        F.count(M.to_cents("billed_amount")).alias("__billed_n"),
        F.sum(M.to_cents("reimbursed_amount")).alias("__reimb_c"),
        F.count(M.to_cents("reimbursed_amount")).alias("__reimb_n"),
    )
    return agg.select(
        "provider_sk", "claim_events", "unique_patients", "rejected_claims",
        M.round_half_up_ratio(F.col("rejected_claims"), F.col("claim_events"), 4).alias("rejection_rate"),
        M.round_half_up_cents_avg(F.col("__billed_c"), F.col("__billed_n")).alias("avg_billed_amount"),
        M.round_half_up_cents_avg(F.col("__reimb_c"), F.col("__reimb_n")).alias("avg_reimbursed_amount"),
    ).orderBy(F.col("claim_events").desc(), F.col("provider_sk").asc_nulls_first())


def category_summary(fact_claims: DataFrame, dim_treatment: DataFrame) -> DataFrame:
    """Claims, totals and rate per treatment category."""
    joined = fact_claims.join(dim_treatment.select("treatment_sk", "treatment_category"), "treatment_sk", "left")
    agg = joined.groupBy("treatment_category").agg(
        F.count(F.lit(1)).cast("bigint").alias("claims"),
        F.sum(M.to_cents("billed_amount")).alias("__billed_c"),
        F.sum(M.to_cents("reimbursed_amount")).alias("__reimb_c"),
    )
    return agg.select(
        "treatment_category", "claims",
        M.cents_to_double("__billed_c").alias("billed_total"),
        M.cents_to_double("__reimb_c").alias("reimbursed_total"),
        M.round_half_up_ratio(F.col("__reimb_c"), F.col("__billed_c"), 4).alias("reimbursement_rate"),
    )


def patient_journey(fact_claims: DataFrame, fact_prescriptions: DataFrame, fact_visits: DataFrame,
                    rows: tuple[int, int, int] = (0, 0, 0)) -> DataFrame:
    """Every claim, prescription and visit of a patient in date order,
    numbered per patient (skew-safe row number, see keys.group_row_number).
    The inputs need no key of their own: unkeyed lines will do. Their events
    are written one kind after the other, of many ``rows`` in slices."""
    events = (
        fact_claims.select("patient_sk", F.col("date_sk").alias("event_date_sk"), F.lit("claim").alias("event_type"),
                           F.col("claim_id").alias("event_id"), F.col("billed_amount").alias("amount"))
        .unionByName(fact_prescriptions.select(
            "patient_sk", F.col("date_sk").alias("event_date_sk"), F.lit("prescription").alias("event_type"),
            F.col("prescription_id").alias("event_id"), F.col("quantity").cast("double").alias("amount")))
        .unionByName(fact_visits.select(
            "patient_sk", F.col("admission_date_sk").alias("event_date_sk"), F.lit("visit").alias("event_type"),
            F.col("visit_id").alias("event_id"), F.col("length_of_stay_days").cast("double").alias("amount")))
    )
    slices = [(F.col("event_type") == kind) & own for kind, n in zip(("claim", "prescription", "visit"), rows)
              for own in hash_slices("event_id", n // 2)]  # their lines are joined already: half the shuffles of a slice
    return group_row_number(events, ["patient_sk"], ["event_date_sk", "event_type", "event_id", "amount"], "step",
                            WHOLE_JOURNEY, slices)


def regional_report(fact_claims: DataFrame, dim_provider: DataFrame, dim_region: DataFrame,
                    dim_treatment: DataFrame) -> DataFrame:
    """Claims and totals by region, provider type, category and month."""
    prov = dim_provider.select("provider_sk", "provider_type", "region_sk").join(
        dim_region.select("region_sk", "region_name"), "region_sk", "left")
    joined = (
        fact_claims.join(prov, "provider_sk", "left")
        .join(dim_treatment.select("treatment_sk", "treatment_category"), "treatment_sk", "left")
        .withColumn("year", M.int_div(F.col("date_sk"), F.lit(10000)).cast("int"))
        .withColumn("month", F.pmod(M.int_div(F.col("date_sk"), F.lit(100)), F.lit(100)).cast("int"))
    )
    agg = joined.groupBy("region_name", "provider_type", "treatment_category", "year", "month").agg(
        F.count(F.lit(1)).cast("bigint").alias("claims"),
        F.sum(M.to_cents("billed_amount")).alias("__billed_c"),
        F.sum(M.to_cents("reimbursed_amount")).alias("__reimb_c"),
    )
    return agg.select(
        "region_name", "provider_type", "treatment_category", "year", "month", "claims",
        M.cents_to_double("__billed_c").alias("billed_total"),
        M.cents_to_double("__reimb_c").alias("reimbursed_total"),
    )


def _counts_by_name(row: DataFrame, name: str, counts: dict[str, tuple[str, str]], out: tuple[str, str]) -> DataFrame:
    """One row per entry of ``counts`` (name -> two columns) from one row of counts."""
    entries = [F.struct(F.lit(k).alias(name), F.col(a).cast("bigint").alias(out[0]), F.col(b).cast("bigint").alias(out[1]))
               for k, (a, b) in counts.items()]
    return row.select(F.inline(F.array(*entries)))


def invalid_month_counts(raw_claims: DataFrame, raw_prescriptions: DataFrame) -> DataFrame:
    """Rows per source whose month text does not give a valid date. Both
    sources go through one aggregation of their months."""
    from claimsmith.functions.calendar import month_start
    from claimsmith.functions.text import safe_month

    months = raw_claims.select(F.lit("claims").alias("source_name"), "claim_month").unionByName(
        raw_prescriptions.select(F.lit("prescriptions").alias("source_name"), "claim_month"))
    bad = month_start(safe_month("claim_month")).isNull()
    both = ("claims", "prescriptions")
    row = months.agg(*[f(F.col("source_name") == s).alias(f"{k}_{s}") for s in both for k, f in (
        ("rows", F.count_if), ("bad", lambda own: F.count_if(own & bad)))])  # no rows: counts of 0
    return _counts_by_name(row, "source_name", {s: (f"rows_{s}", f"bad_{s}") for s in both}, ("rows", "invalid_month_rows"))


def unparsable_amount_counts(raw_claims: DataFrame) -> DataFrame:
    """Per amount column the rows, and those whose text is there but is
    not an amount (cleaning turns them into null). One pass."""
    from claimsmith.functions.text import money_decimal

    names = ("total_billed", "total_reimbursed")
    row = raw_claims.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col(c).isNotNull() & money_decimal(c).isNull()).alias(f"lost_{c}") for c in names])
    return _counts_by_name(row, "column_name", {c: ("rows", f"lost_{c}") for c in names}, ("rows", "unparsable_rows"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for many tables in one job."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).cast("bigint").alias("row_count"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stage_row_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(layer, table_name, row_count) for every table of every layer, one job."""
    parts = [table_row_counts(tables).select(F.lit(layer).alias("layer"), "table_name", "row_count")
             for layer, tables in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
