"""Registered queries against their DuckDB SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, _rows

QUICK = ["n1_claims_kpi", "b9_fact_reimbursements", "d9_claim_events_yearly", "c3_clean_claims_agg",
         "q1_q7_python_checks_broken", "q8_q12_sql_checks_broken", "n4_provider_anomaly_top20_coarse", "d11_patients",
         "d13_visits", "s5_source_health_summary", "x7_unparsable_amounts", "x1_category_summary",
         "x4_regional_report", "n1_claims_kpi_synthesized"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_of_the_catalogue_has_an_oracle():
    from claimsmith.plans.catalog import QUERIES

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(o)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "claims_volume", "billed_total", "reimbursed_total", "reimbursement_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, res.fetchall())


@pytest.mark.parametrize("name,conf", [
    ("n1_claims_kpi", ("spark.sql.session.timeZone", "America/Los_Angeles")),
    ("d9_claim_events", ("spark.sql.session.timeZone", "America/Los_Angeles")),
    ("c3_clean_claims_agg", ("spark.sql.ansi.enabled", "false")),
    ("d10_prescription_events", ("spark.sql.ansi.enabled", "false")),
    ("b6_fact_claims", ("spark.sql.adaptive.enabled", "false")),
])
def test_session_settings_do_not_change_results(spark, duck, name, conf):
    key, value = conf
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        df = E.queries()[name](spark, SF_SMALL)
        got = _rows(df.columns, df.collect())
    finally:
        spark.conf.set(key, old)
    res = duck.execute(E.oracle_sql()[name])
    assert got == _rows([d[0] for d in res.description], res.fetchall())


def test_pipeline_end_to_end_matches_oracle(spark, duck, tmp_path):
    """CSV snapshot -> clean -> synthesize -> star -> KPI through the stage
    runners (run-date partitions, concurrent writes, scratch cleanup) equals
    the SQL statement of the synthesised-flow KPI."""
    from claimsmith.operators import analytics as N
    from claimsmith.plans import pipeline as P
    from claimsmith.sources import adapters as A
    from claimsmith.sources import io

    t = A.Tables(spark, SF_SMALL)
    for name, df in {"providers": A.region_providers(t), "regions": A.regions(t), "claims": A.claims_agg(t),
                     "prescriptions": A.prescriptions_agg(t)}.items():
        io.write_raw_snapshot(df.select([df[c].cast("string") for c in df.columns]), P.SOURCE_COLUMNS[name],
                              str(tmp_path / "in" / name))
    cfg = P.PipelineConfig(root=str(tmp_path / "lake"), run_date="2025-02-01",
                           sources={n: {"primary": str(tmp_path / "missing" / n), "fallback": str(tmp_path / "in" / n)}
                                    for n in P.SOURCE_COLUMNS})
    P.ingest(spark, cfg)
    P.run_transformations(spark, cfg, "all")
    cur = {n: io.read_run_partition(spark, cfg.curated_root, n, cfg.run_date) for n in ("fact_reimbursements",
                                                                                         "dim_date")}
    kpi = N.claims_kpi(cur["fact_reimbursements"], cur["dim_date"])
    res = duck.execute(E.oracle_sql()["n1_claims_kpi_synthesized"])
    assert _rows(kpi.columns, kpi.collect()) == _rows([d[0] for d in res.description], res.fetchall())
    checks = {r.check_name: r.status for r in P.quality_checks(spark, cfg).collect()}
    assert len(checks) == 11 and checks["python_row_count_reconciliation"] == "PASS"
