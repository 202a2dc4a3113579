
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from claimsmith.functions import text as T
from claimsmith.operators import clean as CL
from claimsmith.operators import synthesize as D
from claimsmith.sources import io
from tests import golden as G


def test_validate_columns_raises(spark):
    df = spark.createDataFrame([Row(a=1, b=2)])
    with pytest.raises(ValueError, match="c"):
        io.validate_columns(df, ["a", "c"])


def test_fallback_and_missing_primary(spark, tmp_path):
    fb = tmp_path / "providers_sample.csv"
    G.write_csv(str(fb), [G.PROVIDERS[0], ("P1", "N1", "hospital", "R1")])
    cols = list(G.PROVIDERS[0])
    df, info = io.read_source(spark, "providers", str(tmp_path / "missing.csv"), str(fb), cols)
    assert info["status"] == "fallback_sample" and info["used_fallback"]
    assert [tuple(r) for r in df.collect()] == [("P1", "N1", "hospital", "R1")]
    with pytest.raises(RuntimeError):
        io.read_source(spark, "providers", str(tmp_path / "missing.csv"), str(fb), cols, allow_fallback=False)
    with pytest.raises(ValueError):
        io.read_source(spark, "providers", str(tmp_path / "missing.csv"), str(fb), cols + ["extra"])


def test_bom_header_and_na_tokens(spark, tmp_path):
    p = tmp_path / "regions.csv"
    G.write_csv(str(p), [G.REGIONS[0], ("R1", "NA", "null")], bom=True)
    df = io.read_csv(spark, str(p), pandas_missing_tokens=True)
    assert df.columns == list(G.REGIONS[0])
    assert [tuple(r) for r in df.collect()] == [("R1", None, None)]


def _claims(spark, count, billed, reimbursed):
    return spark.createDataFrame([Row(provider_id="P1", region_id="R1", treatment_category="cardiology",
                                      claim_month="2025-01", claim_count=count, total_billed=billed,
                                      total_reimbursed=reimbursed, claim_status="approved")])


def _aggregates(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(25):
        billed = round(rng.uniform(0.5, 5000), 2)
        rows.append((f"PR{i % 4}", f"R{i % 3}", f"cat{i}", f"20{20 + i % 5}-{i % 12 + 1:02d}", rng.randrange(1, 70), billed,
                     round(billed * rng.uniform(0.2, 1.6), 2), rng.choice(["approved", "pending", None])))
    return rows, spark.createDataFrame(
        rows, "provider_id string, region_id string, treatment_category string, claim_month string, claim_count long, "
              "total_billed double, total_reimbursed double, claim_status string")


def test_claim_ids_repeat_with_the_seed_only(spark):
    rows, agg = _aggregates(spark, 9)
    ids = lambda seed, parts: {r.claim_id for r in D.synthesize_claim_events(agg, seed, parts).collect()}
    one = ids(77, 3)
    assert len(one) == sum(r[4] for r in rows) and one == ids(77, 7)
    assert not one & ids(78, 3)


def test_event_amounts_keep_totals_and_caps(spark):
    rows, agg = _aggregates(spark, 10)
    events = D.synthesize_claim_events(agg, 1).collect()
    by_category = {}
    for e in events:
        by_category.setdefault(e.treatment_category, []).append(e)
    for r in rows:
        own = by_category[r[2]]
        assert len(own) == r[4]
        assert sum(round(e.billed_amount * 100) for e in own) == round(r[5] * 100)
        assert all(e.reimbursed_amount <= e.billed_amount for e in own)
        if r[6] < r[5] * 0.5:
            assert sum(round(e.reimbursed_amount * 100) for e in own) == round(r[6] * 100)


def test_large_counts_and_amounts_survive(spark, ansi):
    raw = spark.createDataFrame(
        [("3000000000", "20000000000000000.00"), (" +4294967296.9 ", "-1.005"), (".5", "12345678901234567890.12"), ("-.5", "x")],
        "claim_count string, total_billed string")
    got = raw.select(T.positive_count("claim_count").alias("n"), T.non_negative_int("claim_count").alias("z"),
                     T.money_decimal("total_billed").alias("m")).collect()
    assert [(r.n, r.z) for r in got] == [(3000000000, 3000000000), (4294967296, 4294967296), (1, 0), (1, 0)]
    assert [str(r.m) for r in got] == ["20000000000000000.00", "-1.01", "12345678901234567890.12", "None"]


@pytest.mark.parametrize("kind", ["empty", "surplus", "gzip", "missing"])
def test_bad_primary_falls_back_and_says_why(spark, tmp_path, kind):
    fb = tmp_path / "fb.csv"
    fb.write_text("a,b\n1,2\n")
    primary = tmp_path / ("p.csv.gz" if kind == "gzip" else "p.csv")
    if kind != "missing":
        primary.write_bytes({"empty": b"", "surplus": b"a,b\n1,2\n3,4,5,6\n", "gzip": b"a,b\n1,2\n"}[kind])
    df, info = io.read_source(spark, "s", str(primary), str(fb), ["a", "b"])
    assert info["used_fallback"] and info["status"] == "fallback_sample" and info["error"]
    assert [tuple(r) for r in df.collect()] == [("1", "2")]


def test_short_lines_and_quoted_commas_are_kept(spark, tmp_path):
    p = tmp_path / "p.csv"
    p.write_text('a,b\n1\n"x,y",2\n')
    df, info = io.read_source(spark, "s", str(p), None, ["b", "a"])
    assert not info["used_fallback"] and [tuple(r) for r in df.collect()] == [(None, "1"), ("2", "x,y")]


def test_scratch_scopes_of_overlapping_stages(spark):
    from claimsmith.operators import keys as K
    from claimsmith.plans.pipeline import run_concurrently
    from threading import Barrier

    meet = Barrier(2)

    def stage(name):
        def run():
            with K.scratch_scope(spark) as own:
                run_concurrently({i: (lambda i=i: K.scratch_table_path(spark, f"{name}{i}")) for i in range(3)})
                meet.wait(30)
                inner = K.scratch_table_path(spark, f"{name}-inner")
                meet.wait(30)
                assert inner in own
                return list(own)
        return run

    found = run_concurrently({"x": stage("x"), "y": stage("y")})
    for name, paths in found.items():
        assert len(paths) == 4 and all(f"/{name}" in p for p in paths)


def test_expansion_is_chunked_but_exact(spark):
    agg = _claims(spark, 20000, 1000.0, 900.0)
    ev = D.synthesize_claim_events(agg, seed=1, num_partitions=4)
    stats = ev.selectExpr("count(*) n", "count(distinct claim_id) u", "sum(billed_amount) b",
                          "min(claim_date) lo", "max(claim_date) hi").first()
    assert (stats.n, stats.u) == (20000, 20000)
    assert round(stats.b, 2) == 1000.0
    assert (str(stats.lo), str(stats.hi)) == ("2025-01-01", "2025-01-28")


def test_clean_claims_dirty_values(spark, ansi):
    raw = spark.createDataFrame(
        [(" p1 ", "r1", " Cardiology ", "2025-01-15", "20.0", "100.00", "abc", None),
         ("P1", "R1", "x", "bad", "-3", "1", "2", "  APPROVED "),
         ("P1", "R1", "x", None, "abc", None, None, "")],
        "provider_id string, region_id string, treatment_category string, claim_month string, claim_count string, "
        "total_billed string, total_reimbursed string, claim_status string")
    rows = [tuple(r) for r in CL.clean_claims_agg(raw).collect()]
    assert rows == [("P1", "R1", "cardiology", "2025-01", 20, 100.0, None, "approved"),
                    ("P1", "R1", "x", "", 1, 1.0, 2.0, "approved"),
                    ("P1", "R1", "x", None, 1, None, None, "")]


def test_patients_and_visits_invariants(spark):
    claims = D.synthesize_claim_events(_claims(spark, 40, 4000.0, 3000.0), seed=5)
    rx = D.synthesize_prescription_events(spark.createDataFrame(
        [Row(provider_id="P9", region_id="R1", treatment_category="x", claim_month="2025-01", prescription_count=4,
             total_quantity=9)]), seed=5)
    providers = spark.createDataFrame([Row(provider_id="P1", provider_type="Clinique", region_id="R52")])
    pats = D.synthesize_patients(claims, rx, providers).collect()
    assert len(pats) == 44
    regions = {p.region_id for p in pats}
    assert regions == {"R52", "R11"}  # unknown provider P9 -> fallback R11
    assert all(1940 <= p.birth_date.year < 1995 and 2018 <= p.registration_date.year < 2024 for p in pats)
    visits = D.synthesize_visits(claims, providers, seed=5, threshold=0).collect()
    assert len(visits) == 40  # 'clinique' is hospital-like
    assert all(1 <= (v.discharge_date - v.admission_date).days <= 5 for v in visits)
    assert all(len(v.diagnosis_code) == 4 and v.diagnosis_code.startswith("D") for v in visits)


def test_run_metadata_and_sql_over(spark):
    from claimsmith.operators.analytics import table_row_counts

    a = spark.range(3).toDF("x")
    b = spark.range(5).toDF("x")
    counts = table_row_counts({"t_b": b, "t_a": a})
    meta = io.run_metadata(counts, "2025-02-01").collect()
    assert [(m.table_name, m.row_count, m.run_date) for m in meta] == [("t_a", 3, "2025-02-01"),
                                                                        ("t_b", 5, "2025-02-01")]
    out = io.sql_over(spark, {"cs_t_a": a, "cs_t_b": b},
                      "SELECT count(*) AS n FROM {cs_t_a} JOIN {cs_t_b} USING (x)").first()
    assert out.n == 3


def test_missing_parquet_table_and_bad_layer(spark, tmp_path):
    from claimsmith.plans import pipeline as P

    io.write_run_partition(spark.range(2).toDF("x"), str(tmp_path), "present", "2025-02-01")
    assert io.read_run_partition(spark, str(tmp_path), "present", "2025-02-01").count() == 2
    with pytest.raises(FileNotFoundError, match="absent"):
        io.read_run_partition(spark, str(tmp_path), "absent", "2025-02-01")
    with pytest.raises(ValueError):
        P.run_transformations(spark, P.PipelineConfig(root=str(tmp_path), run_date="2025-02-01"), "everything")


def test_one_huge_aggregate_row_is_spread(spark):
    from pyspark.sql import functions as F

    agg = _claims(spark, 100_000, 1_000_000.0, 900_000.0)
    ev = D.synthesize_claim_events(agg, seed=3, num_partitions=4)
    per_part = [r["count"] for r in ev.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per_part) == 100_000 and len(per_part) >= 3 and max(per_part) < 60_000


def test_run_concurrently_returns_results_and_raises_failures():
    from claimsmith.plans.pipeline import run_concurrently

    assert run_concurrently({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}

    def boom():
        raise OSError("write failed")

    with pytest.raises(OSError, match="write failed"):
        run_concurrently({"ok": lambda: 1, "bad": boom})


def test_provider_lookups_do_not_sort_the_events(spark):
    """A hot provider's events would meet in one task of a sort-merge join."""
    claims = spark.range(300).select(
        F.concat(F.lit("c"), "id").alias("claim_id"), F.concat(F.lit("p"), "id").alias("patient_id"),
        F.when(F.col("id") % 50 > 0, "A").otherwise("B").alias("provider_id"), F.lit(None).cast("string").alias("region_id"),
        F.lit("t").alias("treatment_id"), F.lit(None).cast("date").alias("claim_date"))
    # Repeated and unknown providers too.
    providers = spark.createDataFrame([("A", "R2", "clinic"), ("A", "R1", "clinic"), (None, "R1", None)],
                                      "provider_id string, region_id string, provider_type string")
    patients = D.synthesize_patients(claims, claims.select("patient_id", "provider_id"), providers)
    visits = D.synthesize_visits(claims, providers)
    for found in (patients, visits):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {(r.region_id, r.n) for r in patients.groupBy("region_id").agg(F.count("*").alias("n")).collect()} == {
        ("R1", 294), ("R11", 6)}
    assert visits.where("provider_id = 'A'").count() == 2 * 294
