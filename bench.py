"""Benchmark: the reference's pipeline stages plus the serving queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Input preparation (not timed): the monthly claim / prescription aggregates,
providers and regions are derived from the test tables of BENCH_SF_DIR
(sources/adapters.py) and written as the four raw CSV sources. Timed, in
order, like the reference's golden run: ingest (primary missing -> fallback,
S2-S5), stage_clean (C1-C4), synthesize_events (D9-D13), build_dimensions
(B1-B5), build_facts (B6-B9), quality_checks (Q1-Q12), then the serving
queries over the written curated tables (N1, N2, N4, N5) and the flagship
catalog query computed from the raw test tables. Prints one JSON line; its
``reference_scale_stages`` field times the same stages on the reference's own
21 sample rows (not part of ``value``).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="claimsmith-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("claimsmith-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from claimsmith.operators import analytics as N
    from claimsmith.plans import pipeline as P
    from claimsmith.plans.catalog import QUERIES
    from claimsmith.sources import adapters as A
    from claimsmith.sources import io

    run_date = "2025-02-01"
    t = A.Tables(spark, sf_dir)
    inputs = f"{scratch}/inputs"
    prepared = {
        "providers": A.region_providers(t),
        "regions": A.regions(t),
        "claims": A.claims_agg(t),
        "prescriptions": A.prescriptions_agg(t),
    }
    for name, df in prepared.items():
        io.write_raw_snapshot(df.select([df[c].cast("string") for c in df.columns]), P.SOURCE_COLUMNS[name],
                              f"{inputs}/{name}")
    cfg = P.PipelineConfig(
        root=f"{scratch}/lake",
        run_date=run_date,
        sources={n: {"primary": f"{scratch}/unreachable/{n}.csv", "fallback": f"{inputs}/{n}"}
                 for n in P.SOURCE_COLUMNS},
    )

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def timed(name, fn):
        """Time one step; a failing step is reported (time null) instead of
        ending the run without a result line."""
        t0 = time.perf_counter()
        try:
            fn()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - reported in the JSON line
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"

    timed("ingest", lambda: P.ingest(spark, cfg).collect())
    for stage, fn in P.STAGES.items():
        timed(stage, lambda fn=fn: fn(spark, cfg))
    timed("quality_checks", lambda: P.quality_checks(spark, cfg).collect())

    cur = {n: io.read_run_partition(spark, cfg.curated_root, n, run_date) for n in P.DIMENSIONS + P.FACTS}
    timed("n1_claims_kpi_curated", lambda: N.claims_kpi(cur["fact_reimbursements"], cur["dim_date"]).collect())
    timed("n2_claims_kpi_unrounded_curated",
          lambda: N.claims_kpi_unrounded(cur["fact_reimbursements"], cur["dim_date"]).collect())
    timed("n4_provider_anomaly_top20_curated", lambda: N.provider_anomaly_ranking(cur["fact_claims"]).collect())
    timed("n5_provider_snapshot_curated", lambda: N.provider_snapshot(cur["fact_claims"]).collect())
    timed("n1_claims_kpi_from_tables", lambda: QUERIES["n1_claims_kpi"](spark, sf_dir).collect())

    # The same stages on the reference's own 21 sample rows (its golden-run
    # input), reported apart from the sf0.1 total for a same-input comparison.
    from tests import golden as G

    sample_dir = f"{scratch}/sample"
    os.makedirs(sample_dir, exist_ok=True)
    for name, rows in G.SOURCES.items():
        G.write_csv(f"{sample_dir}/{name}_sample.csv", rows, bom=True)
    small = P.PipelineConfig(
        root=f"{scratch}/sample_lake", run_date=run_date, seed=G.GOLDEN_SEED,
        sources={n: {"primary": f"{scratch}/unreachable/{n}.csv", "fallback": f"{sample_dir}/{n}_sample.csv"}
                 for n in G.SOURCES},
    )
    reference_scale: dict[str, float] = {}
    for name, fn in [("ingest", lambda: P.ingest(spark, small).collect())] + [
            (k, (lambda f=f: f(spark, small))) for k, f in P.STAGES.items()] + [
            ("quality_checks", lambda: P.quality_checks(spark, small).collect())]:
        t0 = time.perf_counter()
        fn()
        reference_scale[name] = round(time.perf_counter() - t0, 3)

    from claimsmith.operators.keys import clear_scratch

    clear_scratch(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "pipeline_and_queries_total",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    result["reference_scale_stages"] = reference_scale
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
