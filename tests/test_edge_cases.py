"""Edge cases the reference does not test (FIXTURES section 4)."""

import datetime as dt

from pyspark.sql import Row

from claimsmith.operators import analytics as N
from claimsmith.operators import quality as Q
from claimsmith.operators import star as B
from claimsmith.operators import synthesize as D

FC_SCHEMA = ("claim_sk long, claim_id string, patient_sk long, provider_sk long, treatment_sk long, date_sk int, "
             "billed_amount double, reimbursed_amount double, claim_status string")


def test_checks_on_empty_tables(spark):
    empty_fc = spark.createDataFrame([], FC_SCHEMA)
    curated = {
        "fact_claims": empty_fc,
        "fact_prescriptions": spark.createDataFrame([], "prescription_sk long, treatment_sk long"),
        "dim_patient": spark.createDataFrame([], "patient_sk long"),
        "dim_provider": spark.createDataFrame([], "provider_sk long"),
        "dim_treatment": spark.createDataFrame([], "treatment_sk long"),
        "fact_reimbursements": spark.createDataFrame([], "total_claims long"),
    }
    staging = {"stg_claims_events": spark.createDataFrame([], "claim_id string"),
               "stg_prescriptions_events": spark.createDataFrame([], "prescription_id string")}
    rows = {r.check_name: (r.status, r.details) for r in Q.python_check_rows(curated, staging).collect()}
    assert rows["python_claim_id_uniqueness"] == ("PASS", "total=0, unique=0")
    assert all(s == "PASS" for s, _ in rows.values())
    sql = {r.check_name: r.details for r in Q.sql_check_rows(curated).collect()}
    assert set(sql.values()) == {"fail_count=0"}


def test_zero_billed_rates_and_high_ratio_boundary(spark):
    lines = spark.createDataFrame(
        [Row(date_sk=20250101, provider_sk=1, treatment_sk=1, billed_amount=0.0, reimbursed_amount=0.0),
         Row(date_sk=20250102, provider_sk=1, treatment_sk=1, billed_amount=100.0, reimbursed_amount=95.0)])
    totals = {r.date_sk: r.reimbursement_rate for r in B.reimbursement_totals(lines).collect()}
    assert totals == {20250101: 0.0, 20250102: 0.95}
    dates = spark.createDataFrame([Row(date_sk=20250101, year=2025, month=1), Row(date_sk=20250102, year=2025,
                                                                                  month=2)])
    kpi = {r.month: r.reimbursement_rate for r in N.claims_kpi(B.reimbursement_totals(lines), dates).collect()}
    assert kpi == {1: None, 2: 0.95}
    fc = spark.createDataFrame(
        [(1, "C1", 1, 1, 1, 20250102, 100.0, 95.0, "approved"), (2, "C2", 1, 1, 1, 20250102, 0.0, 0.0, "rejected"),
         (3, "C3", None, None, None, None, 10.0, 9.6, "approved")], FC_SCHEMA)
    feats = {r.claim_id: (r.reimbursement_ratio, r.is_high_ratio, r.is_potential_duplicate)
             for r in N.claim_anomaly_features(fc).collect()}
    assert feats == {"C1": (0.95, 0, 1), "C2": (0.0, 0, 1), "C3": (0.96, 1, 0)}
    top = N.provider_anomaly_ranking(fc).collect()
    assert [(r.provider_sk, r.claims_count, r.duplicate_pattern_count) for r in top] == [(1, 2, 2)]


def test_top20_tie_break(spark):
    rows = [(i, f"C{i}", i, i, 1, 20250101, 100.0, 99.0, "approved") for i in range(1, 31)]
    top = N.provider_anomaly_ranking(spark.createDataFrame(rows, FC_SCHEMA)).collect()
    assert [r.provider_sk for r in top] == list(range(1, 21))


def test_visit_thresholds(spark):
    agg = spark.createDataFrame([Row(provider_id="P1", region_id="R1", treatment_category="x", claim_month="2025-01",
                                     claim_count=50, total_billed=500.0, total_reimbursed=400.0,
                                     claim_status="approved")])
    claims = D.synthesize_claim_events(agg, seed=7)
    providers = spark.createDataFrame([Row(provider_id="P1", provider_type=None, region_id="R1")],
                                      "provider_id string, provider_type string, region_id string")
    assert D.synthesize_visits(claims, providers, seed=7, threshold=0).count() == 0
    assert D.synthesize_visits(claims, providers, seed=7, threshold=10).count() == 50


def test_single_claim_and_null_totals(spark):
    agg = spark.createDataFrame(
        [("P1", "R1", "x", "2025-01", 1, 12.34, None, "approved"),
         ("P2", "R1", "x", "bad", 2, None, None, "approved")],
        "provider_id string, region_id string, treatment_category string, claim_month string, claim_count int, "
        "total_billed double, total_reimbursed double, claim_status string")
    ev = {r.provider_id + str(r.claim_date): (r.billed_amount, r.reimbursed_amount)
          for r in D.synthesize_claim_events(agg).collect()}
    assert ev["P12025-01-01"] == (12.34, None)
    assert list(v for k, v in ev.items() if k.startswith("P2")) == [(None, None)]


def test_visit_fact_negative_stay_and_null_discharge(spark):
    visits = spark.createDataFrame(
        [("V1", "C1", "S1", dt.date(2025, 1, 5), dt.date(2025, 1, 3), "D100"),
         ("V2", "C1", None, dt.date(2025, 1, 5), None, "D101")],
        "visit_id string, patient_id string, provider_id string, admission_date date, discharge_date date, "
        "diagnosis_code string")
    pat = spark.createDataFrame([Row(patient_sk=1, patient_id="C1")])
    prov = spark.createDataFrame([Row(provider_sk=1, provider_id="S1")])
    got = {r.visit_id: (r.visit_sk, r.provider_sk, r.discharge_date_sk, r.length_of_stay_days)
           for r in B.fact_visits(visits, pat, prov).collect()}
    assert got == {"V1": (1, 1, 20250103, -2), "V2": (2, None, None, None)}
