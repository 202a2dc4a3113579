"""Amounts beyond 64 bits of cents, counts beyond 64 bits, and their reports."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimsmith.functions import money as M
from claimsmith.functions import text as T
from claimsmith.operators import clean as CL
from claimsmith.operators import synthesize as D
from claimsmith.plans import pipeline as P
from claimsmith.sources import adapters as A
from claimsmith.sources import io
from tests.conftest import SF_SMALL

HUGE = "99999999999999999999"
CLAIMS = "provider_id string, region_id string, treatment_category string, claim_month string, claim_count string, " \
         "total_billed string, total_reimbursed string, claim_status string"
ROWS = [("p1", "r1", "x", "2025-01", "3", "100000000000000000.00", "99999999999999999.97", "approved"),
        ("p1", "r1", "y", "2025-01", HUGE, "10.00", "n/a", None), ("p2", "r1", "x", "bad", "-" + HUGE, "", "1.00", "x"),
        ("p2", "r1", "z", None, None, None, None, None), ("p2", "r1", "z", "2025-13", "abc", "1e2", "5", "")]


def test_cents_of_large_amounts_split_and_add_up(spark, ansi):
    df = spark.createDataFrame([("100000000000000000.01", 3), ("-92233720368547758.09", 7), ("999999999999999.99", 2),
                                ("9999999999999999999999999999999.99", 1000)], "amount string, n long")
    seq = df.select("*", F.explode(F.expr("sequence(1L, n)")).alias("seq"))
    parts = seq.withColumn("part", M.allocate_cents(M.to_cents("amount"), F.col("n"), F.col("seq"), M.floor_div_cents))
    for r in parts.groupBy("amount", "n").agg(F.sum("part").alias("total"), F.min("part"), F.max("part"), F.count("part").alias("held")).collect():
        cents = int(r.amount.replace(".", ""))
        assert int(r.total) == cents and r.held == r.n
        quotient, rest = divmod(cents, r.n)
        unit = quotient + (2 * rest > r.n or (2 * rest == r.n and quotient % 2 == 1))
        assert unit in (int(r[3]), int(r[4]))


def test_ratios_and_averages_of_large_cents(spark, ansi):
    df = spark.createDataFrame([(Decimal(3 * 10**20), Decimal(4 * 10**20), 3)], "a decimal(38,0), b decimal(38,0), n long")
    row = df.select(M.round_half_up_ratio(F.col("a"), F.col("b"), 4), M.round_half_up_cents_avg(F.col("a"), F.col("n")),
                    M.round_half_up_ratio(F.col("a"), F.lit(0), 4)).first()
    assert tuple(row) == (0.75, 1e18, None)


def test_counts_beyond_range_are_null_not_one(spark, ansi):
    df = spark.createDataFrame([(HUGE,), ("-" + HUGE,), (" +" + HUGE + ".5",), ("9223372036854775807",), ("0",), (None,), ("x",)], "n string")
    got = [tuple(r) for r in df.select(T.positive_count("n"), T.non_negative_int("n"), T.beyond_range("n")).collect()]
    assert got == [(None, None, True), (1, 0, False), (None, None, True), (2**63 - 1, 2**63 - 1, False), (1, 0, False),
                   (1, 0, False), (1, 0, False)]


def test_events_of_a_large_aggregate_keep_every_cent(spark):
    cleaned = CL.clean_claims_agg(spark.createDataFrame(ROWS, CLAIMS))
    events = D.synthesize_claim_events(cleaned)
    assert events.where("treatment_category = 'y'").count() == 0  # an unknowable count gives no events
    total = events.where("treatment_category = 'x' and provider_id = 'P1'").agg(F.sum(M.to_cents("billed_amount"))).first()[0]
    assert events.where("billed_amount is null and treatment_category = 'x' and provider_id = 'P1'").count() == 0
    assert abs(total - 10**19) < 10**4  # doubles at the edge hold 16 digits


def test_rejected_values_by_hand(spark, ansi):
    raw = spark.createDataFrame(ROWS, CLAIMS)
    got = {(r.column_name, r.rule): r["rows"] for r in CL.rejected_values({"claims": raw}).collect()}
    assert got == {("claim_month", "invalid"): 3, ("claim_count", "clamped"): 3, ("claim_count", "beyond_range"): 1,
                   ("total_billed", "unparsable"): 1, ("total_reimbursed", "unparsable"): 1}
    assert {r["rows"] for r in CL.rejected_values({"claims": raw.limit(0)}).collect()} == {0}


def test_test_tables_hold_values_of_every_rule(spark):
    t = A.Tables(spark, SF_SMALL)
    got = CL.rejected_values({"claims": A.raw_claims(t), "prescriptions": A.raw_prescriptions(t)}).collect()
    assert len(got) == 10 and all(r["rows"] > 0 for r in got if r.column_name != "total_billed")


@pytest.mark.parametrize("rerun", [False, True])
def test_stage_clean_writes_the_counts_of_its_own_pass(spark, tmp_path, rerun):
    cfg = P.PipelineConfig(root=str(tmp_path), run_date="2025-02-01", pandas_missing_tokens=False)
    raw = spark.createDataFrame(ROWS, CLAIMS)
    empty = {n: spark.createDataFrame([], ", ".join(f"{c} string" for c in P.SOURCE_COLUMNS[n])) for n in P.SOURCE_COLUMNS}
    for n, df in (empty | {"claims": raw}).items():
        io.write_raw_snapshot(df, P.SOURCE_COLUMNS[n], f"{cfg.raw_root}/{cfg.run_date}/{n}")
    for _ in range(1 + rerun):
        P.stage_clean(spark, cfg)
    kept = io.read_run_partition(spark, cfg.quality_root, "rejected_values", cfg.run_date)
    want = CL.rejected_values({"claims": raw, "prescriptions": empty["prescriptions"]})
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, want.collect()))
