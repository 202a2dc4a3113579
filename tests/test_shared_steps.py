"""What the large queries compute once, and what they do not write."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from claimsmith.operators import analytics as N
from claimsmith.operators import quality as Q
from claimsmith.operators.keys import add_surrogate_key, hashed_lookup, scratch_scope
from claimsmith.plans.catalog import QUERIES
from claimsmith.sources import adapters as A
from tests.conftest import SF_SMALL


def test_queries_that_read_the_lines_once_do_not_write_them(spark):
    for name in ("b6_fact_claims", "b7_fact_prescriptions", "q8_q12_sql_checks"):
        with scratch_scope(spark) as paths:
            QUERIES[name](spark, SF_SMALL)
            assert not [p for p in paths if os.path.basename(p).startswith("order_lines")], name


def test_treatment_kinds_of_lines_without_a_part(spark, tmp_path):
    lines = spark.createDataFrame([(1,), (1,), (2,), (3,), (9,), (None,)], "l_partkey long")
    parts = spark.createDataFrame([(1, "Rent"), (1, "RENT"), (2, None), (3, "care"), (4, "unused")], "p_partkey long, p_type string")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    t = A.Tables(spark, str(tmp_path))
    kinds = A.treatment_kinds(t)
    category = F.lower("p_type")
    want = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.substring(F.sha2(category, 256), 1, 12), category).distinct()
    assert sorted(map(tuple, kinds.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert kinds.count() == 3
    # The lines are reduced to their part keys before the join.
    plan = kinds._jdf.queryExecution().optimizedPlan().toString().split("Join")[1]
    assert "Aggregate [l_partkey" in plan


def test_large_lookups_are_hashed_and_small_ones_broadcast(spark):
    small = spark.range(10).select("id", F.lit("a").alias("name"))

    def joins(rows):
        df = spark.range(100).join(hashed_lookup(small, rows), "id", "left")
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in joins(10)
    assert "strategy=shuffle_hash" in joins(100_000_000)
    assert "strategy" not in joins(400_000) and "strategy" not in joins(None)


def test_lookups_of_lines_are_not_sorted_at_size(spark, tmp_path):
    """Keys repeat and are null on both sides: hashed lookups give the rows of the others."""
    lines = spark.createDataFrame(
        [(o, p, 1, n, 2.0, 10.0, 0.1, "A", datetime(2024, 1, 2)) for n, (o, p) in enumerate(
            [(1, 1), (1, 2), (2, None), (None, 2), (3, 1), (9, 9), (1, 1)])],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_shipdate timestamp")
    tables = {
        "lineitem": lines,
        "orders": spark.createDataFrame([(1, 7), (1, 8), (2, None), (None, 5), (4, 7)], "o_orderkey long, o_custkey long"),
        "part": spark.createDataFrame([(1, "Rent"), (2, None), (2, "x"), (None, "y")], "p_partkey long, p_type string"),
        "supplier": spark.createDataFrame([(1, 1)], "s_suppkey long, s_nationkey int"),
        "nation": spark.createDataFrame([(1, 1)], "n_nationkey int, n_regionkey int")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    found = {}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (old, "1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            df = A.claim_events(A.Tables(spark, str(tmp_path)))
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("strategy=shuffle_hash") == (2 if limit == "1" else 0)
            found[limit] = sorted(map(str, df.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert found[old] == found["1"] and len(found["1"]) == 13


def test_keys_are_given_without_a_cache(spark):
    before = spark._jsc.getPersistentRDDs().size()
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    cached = []
    frame = type(df)
    persist = frame.persist
    frame.persist = lambda self, *a: cached.append(1) or persist(self, *a)
    try:
        rows = add_surrogate_key(df, "sk", ["k"]).collect()
    finally:
        frame.persist = persist
    assert not cached and spark._jsc.getPersistentRDDs().size() == before
    assert [(r.k, r.id) for r in sorted(rows)] == sorted((i % 7, i) for i in range(1000))
    assert sorted(r.sk for r in rows) == list(range(1, 1001))


def test_claim_metrics_shuffle_claim_ids_only(spark):
    schema = ", ".join(f"{c} {t}" for c, t in Q.FACT_CLAIM_TYPES.items())
    rows = [(1, "a", 1, 1, 1, 1, 2.0, 1.0, "approved"), (2, "a", None, 1, 1, 1, 2.0, 3.0, "void"),
            (3, None, 1, 1, 1, 1, -1.0, None, None), (4, None, 1, 1, 1, 1, 1.0, 1.0, "pending")]
    df = Q.claim_metrics(spark.createDataFrame(rows, schema))
    assert df.first().asDict() == {"unique": 2, "total": 4, "nulls": 3, "status": 1, "amounts": 2, "over": 1}
    assert Q.claim_metrics(spark.createDataFrame([], schema)).first().asDict() == {
        "unique": 0, "total": 0, "nulls": 0, "status": 0, "amounts": 0, "over": 0}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [claim_id" in plan and not [x for x in plan.splitlines() if "Aggregate [claim_id" in x and "amount" in x]


def test_claims_are_not_shuffled_to_meet_few_repeated_patterns(spark):
    rows = [(f"c{i}", i % 40 if i % 40 else None, 1, 1, 1, 2.0, 1.0) for i in range(41)]
    df = N.claim_anomaly_features(spark.createDataFrame(
        rows, "claim_id string, patient_sk long, provider_sk long, treatment_sk long, date_sk int, billed_amount double, "
        "reimbursed_amount double"))
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.claim_id for r in df.collect() if r.is_potential_duplicate) == ["c0", "c40"]
    assert df.count() == 41


def test_anomaly_features_write_what_they_read(spark):
    for name in ("n3_claim_anomaly_features", "n3_claim_anomaly_features_coarse"):
        with scratch_scope(spark) as paths:
            QUERIES[name](spark, SF_SMALL)
            written = [p for p in paths if os.path.basename(p).startswith("claim_lines")]
            assert spark.read.parquet(*written).columns == list(N.FEATURE_INPUTS)
