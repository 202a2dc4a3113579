"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Names follow the operator ids of the inventory (n = analytics, b = star
builders, q = quality, c = cleaning, d = synthesis, x = declared reports,
s = sources). Each query reads the whole test tables of ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.functions import calendar as C
from claimsmith.operators import analytics as N
from claimsmith.operators import clean as CL
from claimsmith.operators import quality as Q
from claimsmith.operators import star as B
from claimsmith.operators import synthesize as D
from claimsmith.operators.keys import _delete_path as delete_path
from claimsmith.operators.keys import hash_slices, scratch_table_path, slice_bounds
from claimsmith.sources import adapters as A
from claimsmith.sources import io
from claimsmith.sources.io import materialize

# Staging frames read by more than one builder are written once (the two
# lineitem-based event kinds share one written join of the order lines).
SHARED_STAGING = ("stg_claims_events", "stg_prescriptions_events", "stg_visits_events")


LINE_COLUMNS = ("claim_id", "provider_sk", "treatment_sk", "date_sk", "billed_amount", "reimbursed_amount", "claim_status")


class Star:
    """Star schema over the adapter staging tables; every piece is built on
    first use only, so a query pays for the dimensions it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = A.Tables(spark, sf_dir)
        self._lazy = _LazyMap(lambda name: A.STAGING[name](self.t), list(A.STAGING))
        self._staged: dict[str, DataFrame] = {}
        self._share = True

    @cached_property
    def _order_lines_path(self) -> str:
        return scratch_table_path(self.spark, "order_lines")

    @cached_property
    def _order_lines(self) -> DataFrame:
        return materialize(A.order_lines(self.t), "order_lines", hash_slices("l_orderkey", self.t.rows("lineitem")),
                           self._order_lines_path)

    def drop_order_lines(self) -> None:
        """Delete the written lines, once no frame that is still to be run reads them."""
        delete_path(self.spark, self._order_lines_path)

    def staging(self, name: str) -> DataFrame:
        if name not in SHARED_STAGING or not self._share:
            return self._lazy[name]
        if name not in self._staged:
            if name == "stg_claims_events":
                df = A.claim_events(self.t, self._order_lines)
            elif name == "stg_prescriptions_events":
                df = A.prescription_events(self.t, self._order_lines)
            else:
                df = materialize(self._lazy[name], name)
            self._staged[name] = df
        return self._staged[name]

    def unshared(self) -> "Star":
        """For a query that reads one of the shared staging frames, once:
        nothing is written for others."""
        self._share = False
        return self

    @property
    def stg(self) -> dict[str, DataFrame]:
        return _LazyMap(self.staging, list(self._lazy))

    def prefetch(self, *names: str) -> "Star":
        """Build independent pieces as concurrent Spark jobs (names of the
        cached properties below, or of shared staging tables)."""
        from claimsmith.plans.pipeline import run_concurrently

        def get(n):
            return lambda: self.staging(n) if n in SHARED_STAGING else getattr(self, n)

        run_concurrently({n: get(n) for n in names})
        return self

    @cached_property
    def dim_region(self) -> DataFrame:
        return B.dim_region(self.stg["stg_regions"])

    @cached_property
    def dim_provider(self) -> DataFrame:
        return B.dim_provider(self.stg["stg_providers"], self.dim_region)

    @cached_property
    def _plain_lines(self) -> DataFrame:
        return A.plain_lines(self.t)

    @cached_property
    def dim_treatment(self) -> DataFrame:
        # Both event kinds have the categories of the same lines; their plans are alike, so Spark runs one.
        kinds = A.treatment_kinds(self.t)
        return B.dim_treatment(kinds, kinds)

    @cached_property
    def dim_patient(self) -> DataFrame:
        return B.dim_patient(self.stg["stg_patients"], self.dim_region)

    @cached_property
    def dim_date(self) -> DataFrame:
        return B.dim_date(self.stg["stg_claims_events"], self.stg["stg_prescriptions_events"],
                          self.stg["stg_visits_events"])

    @cached_property
    def reimbursement_lines(self) -> DataFrame:
        """Claim lines without patients: no order is read, nothing is written."""
        return B.claim_lines(A.claim_events(self.t, self._plain_lines), self.dim_provider, self.dim_treatment).select(
            *LINE_COLUMNS)

    @cached_property
    def patient_lines(self) -> DataFrame:
        """Claim lines with patients, without the claim key (no global sort)."""
        return B.claim_lines(self._lazy["stg_claims_events"], self.dim_provider, self.dim_treatment, self.dim_patient).select(
            "patient_sk", *LINE_COLUMNS)

    @cached_property
    def claim_rows(self) -> DataFrame:
        """The rows of fact_claims without their key, over shared staging."""
        return B.claim_lines(self.stg["stg_claims_events"], self.dim_provider, self.dim_treatment, self.dim_patient)

    @cached_property
    def prescription_rows(self) -> DataFrame:
        return B.prescription_lines(self.stg["stg_prescriptions_events"], self.dim_patient, self.dim_provider, self.dim_treatment)

    @cached_property
    def visit_rows(self) -> DataFrame:
        return B.visit_lines(self._lazy["stg_visits_events"], self.dim_patient, self.dim_provider)

    @cached_property
    def fact_claims(self) -> DataFrame:
        return B.fact_claims(self.stg["stg_claims_events"], self.dim_patient, self.dim_provider, self.dim_treatment,
                             slice_bounds(A.claim_ids(self.t)))

    @cached_property
    def fact_prescriptions(self) -> DataFrame:
        return B.fact_prescriptions(self.stg["stg_prescriptions_events"], self.dim_patient, self.dim_provider,
                                    self.dim_treatment, slice_bounds(A.prescription_ids(self.t)))

    @cached_property
    def fact_visits(self) -> DataFrame:
        return B.fact_visits(self.stg["stg_visits_events"], self.dim_patient, self.dim_provider)

    @cached_property
    def fact_reimbursements(self) -> DataFrame:
        return B.fact_reimbursements(self.reimbursement_lines, slice_bounds(A.claim_amounts(self.t).select(
            C.date_key("claim_date"))))

    def curated(self) -> dict[str, DataFrame]:
        names = ["dim_region", "dim_provider", "dim_treatment", "dim_patient", "dim_date", "fact_claims",
                 "fact_prescriptions", "fact_visits", "fact_reimbursements"]
        return {n: getattr(self, n) for n in names}

    def counted(self) -> dict[str, DataFrame]:
        """Frames with the rows of the curated tables, for counts. A fact has
        one row per event (lookups are left joins on unique keys, and dense
        keys number the rows), and the totals one per group of lines."""
        return {"dim_region": self.dim_region, "dim_provider": self.dim_provider, "dim_treatment": self.dim_treatment,
                "dim_patient": self.dim_patient, "dim_date": self.dim_date, "fact_claims": self.claim_rows,
                "fact_prescriptions": self.prescription_rows, "fact_visits": self.visit_rows,
                "fact_reimbursements": B.reimbursement_cents(self.reimbursement_lines)}


class _LazyMap(dict):
    """dict view that builds entries on access."""

    def __init__(self, getter, keys):
        super().__init__()
        self._getter, self._keys = getter, keys

    def __getitem__(self, key):
        return self._getter(key)

    def __iter__(self):
        return iter(self._keys)

    def keys(self):
        return list(self._keys)


def _star(fn: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Star(spark, sf_dir))


def _tables(fn: Callable[[A.Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(A.Tables(spark, sf_dir))


# --------------------------------------------------------- synthesis flow

def synthesized_claims(t: A.Tables, yearly: bool = False) -> DataFrame:
    # The cleaned aggregate is small and read twice (expansion sizing, then
    # the expansion): written once, like the pipeline's staging table.
    agg = materialize(CL.clean_claims_agg(A.claims_agg(t, yearly=yearly)), "stg_claims_agg")
    return D.synthesize_claim_events(agg)


def large_claims(t: A.Tables) -> DataFrame:
    return D.synthesize_claim_events(materialize(CL.clean_claims_agg(A.large_claims_agg(t)), "stg_claims_agg"))


def synthesized_prescriptions(t: A.Tables) -> DataFrame:
    agg = materialize(CL.clean_prescriptions_agg(A.prescriptions_agg(t)), "stg_prescriptions_agg")
    return D.synthesize_prescription_events(agg)


def synthesized_staging(t: A.Tables) -> dict[str, DataFrame]:
    """C1-C4 + D9-D11 over the aggregate adapters: the reference's staging."""
    providers = CL.clean_providers(A.region_providers(t))
    regions = CL.clean_regions(A.regions(t))
    claims = materialize(synthesized_claims(t), "stg_claims_events")
    rx = materialize(synthesized_prescriptions(t), "stg_prescriptions_events")
    return {
        "stg_providers": providers,
        "stg_regions": regions,
        "stg_claims_events": claims,
        "stg_prescriptions_events": rx,
        "stg_patients": D.synthesize_patients(claims, rx, providers),
    }


def kpi_synthesized(t: A.Tables) -> DataFrame:
    return N.kpi_rows(N.monthly_from_daily(B.daily_cents(synthesized_claims(t))))


def published_orders(t: A.Tables) -> DataFrame:
    """S9 with publication: the orders of each year are written three times as
    a run date of their own; the second version is published after the first,
    the third is not. Returns what readers of the current versions see."""
    root = scratch_table_path(t.spark, "published")
    year = F.year("o_orderdate").cast("string")
    for version, factor, publish in (("v1", 1, True), ("v2", 2, True), ("v3", 3, False)):
        rows = t.orders.select("o_orderkey", (F.col("o_custkey") * factor).alias("amount"), year.alias("run_date"))
        rows.write.partitionBy("run_date").parquet(f"{root}/{version}/orders")
        if publish:
            dates = rows.select("run_date").distinct().withColumns(
                {"version": F.lit(version), "published_at": F.lit(None).cast("timestamp_ntz")})
            dates.coalesce(1).write.mode("append").parquet(f"{root}/log")
    current = io.published_versions(t.spark, f"{root}/log").groupBy("version").agg(F.collect_set("run_date").alias("dates"))
    out = None
    for version, dates in current.collect():  # a row per version, its run dates
        part = t.spark.read.parquet(f"{root}/{version}/orders").where(F.col("run_date").isin(dates))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(F.col("run_date").cast("string").alias("run_date")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").cast("bigint").alias("amount"))


def csv_records(t: A.Tables) -> DataFrame:
    """S4 then S1: a raw CSV snapshot of the records, read back."""
    path = scratch_table_path(t.spark, "csv-records")
    io.write_raw_snapshot(A.csv_records(t), ["record_id", "name", "note"], path)
    return io.read_csv(t.spark, path, keep_empty=True)


def coarse_claim_lines(s: Star) -> DataFrame:
    """Claim lines of the coarse variant (nation providers, yearly dates);
    patients and treatments are the star's own dimensions."""
    provider = B.dim_provider(A.nation_providers(s.t), s.dim_region)
    return B.claim_lines(A.coarse_claim_events(s.t), provider, s.dim_treatment, s.dim_patient)


def anomaly_features(lines: DataFrame) -> DataFrame:
    """N3 over lines that are written once, as far as it reads them."""
    return N.claim_anomaly_features(materialize(lines.select(*N.FEATURE_INPUTS), "claim_lines"))


def _checked(s: Star, broken: bool) -> dict[str, DataFrame]:
    """The curated tables that checks read, built when they are."""
    return _LazyMap(lambda n: _BREAKS[n](getattr(s, n)) if broken and n in _BREAKS else getattr(s, n),
                    ["fact_claims", "fact_prescriptions", "fact_reimbursements", "dim_patient", "dim_provider", "dim_treatment"])


_BREAKS = {"fact_claims": A.break_claims, "fact_prescriptions": A.break_prescriptions, "fact_reimbursements": A.break_totals}


def _python_checks(s: Star, broken: bool = False) -> DataFrame:
    return Q.python_check_rows(_checked(s, broken), s.stg)


def _sql_checks(s: Star, broken: bool = False) -> DataFrame:
    return Q.sql_check_rows(_checked(s.unshared(), broken))


def _journey(s: Star) -> DataFrame:
    """X2 over written events; nothing reads the order lines behind them again."""
    lines, orders = s.t.rows("lineitem"), s.t.rows("orders")
    out = N.patient_journey(s.claim_rows, s.prescription_rows, s.visit_rows, (lines, lines, orders))
    s.drop_order_lines()
    return out


def _run_metadata(s: Star) -> DataFrame:
    """S12 without its time of publication."""
    return io.run_metadata(N.table_row_counts(s.counted()), "2025-02-01").drop("published_at")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # analytics (flagship first)
    "n1_claims_kpi": _tables(lambda t: N.kpi_rows(N.monthly_from_daily(B.daily_cents(A.claim_amounts(t))))),
    "n2_claims_kpi_unrounded": _tables(
        lambda t: N.kpi_rows_unrounded(N.monthly_from_daily(B.daily_cents(A.claim_amounts(t))))),
    "n3_claim_anomaly_features": _star(lambda s: anomaly_features(s.patient_lines)),
    "n4_provider_anomaly_top20": _star(lambda s: N.provider_anomaly_ranking(s.patient_lines)),
    "n5_provider_snapshot": _star(lambda s: N.provider_snapshot(s.patient_lines)),
    "n3_claim_anomaly_features_coarse": _star(lambda s: anomaly_features(coarse_claim_lines(s))),
    "n4_provider_anomaly_top20_coarse": _star(lambda s: N.provider_anomaly_ranking(coarse_claim_lines(s))),
    # star builders
    "b1_dim_region": _star(lambda s: s.dim_region),
    "b2_dim_provider": _star(lambda s: s.dim_provider),
    "b3_dim_treatment": _star(lambda s: s.dim_treatment),
    "b4_dim_patient": _star(lambda s: s.dim_patient),
    "b5_dim_date": _star(lambda s: s.dim_date),
    "b6_fact_claims": _star(lambda s: s.unshared().fact_claims),
    "b7_fact_prescriptions": _star(lambda s: s.unshared().fact_prescriptions),
    "b8_fact_visits": _star(lambda s: s.unshared().fact_visits),
    "b9_fact_reimbursements": _star(lambda s: s.fact_reimbursements),
    # quality
    "q1_q7_python_checks": _star(_python_checks),
    "q8_q12_sql_checks": _star(_sql_checks),
    "q1_q7_python_checks_broken": _star(lambda s: _python_checks(s, broken=True)),
    "q8_q12_sql_checks_broken": _star(lambda s: _sql_checks(s, broken=True)),
    # source reports
    "s1_csv_records": _tables(csv_records),
    "s9_published_versions": _tables(published_orders),
    "s5_source_health_summary": _tables(lambda t: io.source_health_summary(A.ingestion_records(t))),
    "s6_source_health_report": _tables(lambda t: io.source_health_report(A.ingestion_records(t))),
    "s12_run_metadata": _star(_run_metadata),
    # declared reports
    "x1_category_summary": _star(lambda s: N.category_summary(s.reimbursement_lines, s.dim_treatment)),
    "x2_patient_journey": _star(_journey),
    "x4_regional_report": _star(
        lambda s: N.regional_report(s.reimbursement_lines, s.dim_provider, s.dim_region, s.dim_treatment)),
    "s13_table_row_counts": _star(lambda s: N.table_row_counts(s.counted())),
    "x6_stage_row_counts": _star(lambda s: N.stage_row_counts({
        "staging": {n: s.stg[n] for n in ("stg_regions", "stg_providers", "stg_patients", "stg_claims_events",
                                          "stg_prescriptions_events", "stg_visits_events")},
        "curated": s.counted()})),
    # cleaning of dirty raw text
    "c1_clean_providers": _tables(lambda t: CL.clean_providers(A.raw_providers(t))),
    "c2_clean_regions": _tables(lambda t: CL.clean_regions(A.raw_regions(t))),
    "c3_clean_claims_agg": _tables(lambda t: CL.clean_claims_agg(A.raw_claims(t))),
    "c4_clean_prescriptions_agg": _tables(lambda t: CL.clean_prescriptions_agg(A.raw_prescriptions(t))),
    "x5_invalid_months": _tables(lambda t: N.invalid_month_counts(A.raw_claims(t), A.raw_prescriptions(t))),
    "x7_unparsable_amounts": _tables(lambda t: N.unparsable_amount_counts(A.raw_claims(t))),
    "x8_rejected_values": _tables(lambda t: CL.rejected_values({"claims": A.raw_claims(t), "prescriptions": A.raw_prescriptions(t)})),
    # synthesis
    "d9_claim_events": _tables(lambda t: synthesized_claims(t)),
    "d9_claim_events_yearly": _tables(lambda t: synthesized_claims(t, yearly=True)),
    "d9_claim_events_large": _tables(large_claims),
    "d10_prescription_events": _tables(synthesized_prescriptions),
    "d11_patients": _tables(lambda t: synthesized_staging(t)["stg_patients"]),
    "d13_visits": _tables(lambda t: D.synthesize_visits(
        materialize(synthesized_claims(t), "stg_claims_events"), CL.clean_providers(A.region_providers(t)))),
    "n1_claims_kpi_synthesized": _tables(kpi_synthesized),
}
