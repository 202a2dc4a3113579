"""Print the physical plans of the main operators (markdown on stdout).

    python tools/show_plans.py [sf_dir]

Builds a small lake with the pipeline (adapter inputs of ``sf_dir``) in a
fresh scratch folder, then explains: the flagship KPI over the curated
tables, the fact_claims build, the duplicate-pattern features, the quality
metrics, patient synthesis and the dense-key write.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from claimsmith.operators import analytics as N
    from claimsmith.operators import quality as Q
    from claimsmith.operators import star as B
    from claimsmith.operators import synthesize as D
    from claimsmith.plans import pipeline as P
    from claimsmith.sources import adapters as A
    from claimsmith.sources import io

    scratch = tempfile.mkdtemp(prefix="claimsmith-plans-")
    t = A.Tables(spark, sf_dir)
    for name, df in {"providers": A.region_providers(t), "regions": A.regions(t), "claims": A.claims_agg(t),
                     "prescriptions": A.prescriptions_agg(t)}.items():
        io.write_raw_snapshot(df.select([df[c].cast("string") for c in df.columns]), P.SOURCE_COLUMNS[name],
                              f"{scratch}/in/{name}")
    cfg = P.PipelineConfig(root=f"{scratch}/lake", run_date="2025-02-01",
                           sources={n: {"primary": f"{scratch}/missing/{n}", "fallback": f"{scratch}/in/{n}"}
                                    for n in P.SOURCE_COLUMNS})
    P.ingest(spark, cfg)
    P.run_transformations(spark, cfg, "all")
    cur = {n: io.read_run_partition(spark, cfg.curated_root, n, cfg.run_date) for n in P.DIMENSIONS + P.FACTS}
    stg = {n: io.read_run_partition(spark, cfg.staging_root, n, cfg.run_date)
           for n in P.STAGING_CLEAN + P.STAGING_EVENTS}

    from claimsmith.plans.catalog import QUERIES

    shown = {
        "N1 monthly KPI from the test tables": QUERIES["n1_claims_kpi"](spark, sf_dir),
        "N1 monthly KPI over the curated tables": N.claims_kpi(cur["fact_reimbursements"], cur["dim_date"]),
        "B6 fact_claims lookups (before the dense key)": B.claim_lines(
            stg["stg_claims_events"], cur["dim_provider"], cur["dim_treatment"], cur["dim_patient"]).select(
            "claim_id", "patient_sk", "provider_sk", "treatment_sk", "date_sk", "billed_amount",
            "reimbursed_amount", "claim_status"),
        "N3 duplicate-pattern features": N.claim_anomaly_features(cur["fact_claims"]),
        "N4 provider top 20": N.provider_anomaly_ranking(cur["fact_claims"]),
        "Q1-Q7 check rows": Q.python_check_rows(cur, stg),
        "D11 patients": D.synthesize_patients(stg["stg_claims_events"], stg["stg_prescriptions_events"],
                                              stg["stg_providers"]),
        "D9 claim events (chunked expansion)": D.synthesize_claim_events(stg["stg_claims_agg"]),
    }
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `python tools/show_plans.py`; final adaptive plans after execution.\n")
    for title, df in shown.items():
        df.collect()
        print(f"## {title}\n\n```\n{_plan(df)}\n```\n")


if __name__ == "__main__":
    main()
