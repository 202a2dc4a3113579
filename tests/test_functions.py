"""Column helpers: ANSI-safe casts, clamps, months, money splits."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsmith.functions import calendar as C
from claimsmith.functions import hashing as H
from claimsmith.functions import money as M
from claimsmith.functions import text as X


def _one_col(spark, values, dtype=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def test_int_from_text_legacy_semantics(spark, ansi):
    cases = {"20": 20, "20.0": 20, "20.9": 20, ".5": 0, "5.": 5, "+7": 7, " 7 ": 7, "-3": -3,
             "1e2": None, "abc": None, "": None, "NaN": None, "20d": None, None: None, "99999999999": 99999999999,
             "99999999999999999999": None}
    df = _one_col(spark, list(cases))
    got = {r.x: r.v for r in df.select("x", X.int_from_text("x").alias("v")).collect()}
    assert got == cases


def test_count_clamps(spark, ansi):
    df = _one_col(spark, ["20", "0", "-3", "abc", None, "2.9"])
    rows = df.select(X.positive_count("x").alias("p"), X.non_negative_int("x").alias("q")).collect()
    assert [r.p for r in rows] == [20, 1, 1, 1, 1, 2]
    assert [r.q for r in rows] == [20, 0, 0, 0, 0, 2]


def test_bigint_counts_accepted(spark):
    df = _one_col(spark, [3, 0], T.LongType())
    assert [r.p for r in df.select(X.positive_count("x").alias("p")).collect()] == [3, 1]


def test_month_and_status(spark, ansi):
    df = _one_col(spark, ["2025-01", "2025-01-15", "bad", None, "2025-13"])
    rows = df.select(X.safe_month("x").alias("m"), C.month_start(X.safe_month("x")).alias("d")).collect()
    assert [r.m for r in rows] == ["2025-01", "2025-01", "", None, "2025-13"]
    assert [str(r.d) if r.d else None for r in rows] == ["2025-01-01", "2025-01-01", None, None, None]
    st_df = _one_col(spark, [None, "", "  APPROVED ", "Pending"])
    got = [r.s for r in st_df.select(X.status_with_default("x", "approved").alias("s")).collect()]
    assert got == ["approved", "", "approved", "pending"]


def test_money_cast(spark, ansi):
    df = _one_col(spark, ["9200.00", "12.345", "n/a", None, " 7.5 "])
    got = [r.v for r in df.select(X.money_double("x").alias("v")).collect()]
    assert got == [9200.0, 12.35, None, None, 7.5]


def test_missing_tokens(spark):
    df = _one_col(spark, ["NA", "null", "x", "N/A"])
    assert [r.v for r in df.select(X.null_missing_tokens("x").alias("v")).collect()] == [None, None, "x", None]


def _alloc(spark, total_cents, n):
    df = spark.range(1, n + 1).select(F.col("id").cast("int").alias("seq"))
    expr = M.allocate_cents(F.lit(total_cents).cast("bigint"), F.lit(n), F.col("seq")).alias("c")
    return [r.c for r in df.orderBy("seq").select(expr).collect()]


def test_allocation_half_even_tie_and_remainder(spark):
    assert _alloc(spark, 469, 2) == [234, 235]  # 4.69 / 2: tie, even unit 2.34
    assert _alloc(spark, 471, 2) == [236, 235]  # 4.71 / 2: tie, odd 235 rounds up
    assert _alloc(spark, 0, 3) == [0, 0, 0]
    parts = _alloc(spark, 5, 7)                 # below half a cent each
    assert sum(parts) == 5 and parts[:-1] == [1] * 6 and parts[-1] == -1


@settings(max_examples=25, deadline=None)
@given(total=st.integers(min_value=-10**9, max_value=10**12), n=st.integers(min_value=1, max_value=40))
def test_allocation_sums_to_total(spark, total, n):
    parts = _alloc(spark, total, n)
    assert len(parts) == n and sum(parts) == total
    unit = parts[0] if n > 1 else None
    if unit is not None:
        assert all(p == unit for p in parts[:-1])
        assert abs(unit * 100 - total * 100 / n) <= 50  # within half a cent of the exact share


def test_integer_allocation(spark):
    df = spark.range(1, 4).select(F.col("id").cast("int").alias("seq"))
    got = [r.q for r in df.orderBy("seq").select(M.allocate_integer(F.lit(10), F.lit(3), F.col("seq")).alias("q"))
           .collect()]
    assert got == [3, 3, 4]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(130.0, 100.0), (None, 100.0), (90.0, 100.0)], "r double, b double")
    got = [r.v for r in df.select(M.cap_at(F.col("r"), F.col("b")).alias("v")).collect()]
    assert got == [100.0, None, 90.0]


def test_ratio_rounding_half_up(spark):
    df = spark.createDataFrame([(1955000, 2335000), (13300 * 100, 32), (1, 8), (-1, 8), (5, 0)], "n long, d long")
    got = [r.v for r in df.select(M.round_half_up_ratio(F.col("n"), F.col("d"), 4).alias("v")).collect()]
    assert got == [0.8373, 41562.5, 0.125, -0.125, None]
    avg = df.limit(2).select(M.round_half_up_cents_avg(F.col("n"), F.col("d")).alias("v")).collect()
    assert avg[1].v == 415.63  # 13300 / 32 = 415.625 -> 415.63


def test_date_spread_wraps_after_28(spark):
    df = spark.range(1, 30).select(F.col("id").cast("int").alias("seq"))
    days = [r.d.day for r in df.orderBy("seq").select(C.day_in_spread(C.month_start(F.lit("2025-02")), F.col("seq")).alias("d"))
            .collect()]
    assert days[:28] == list(range(1, 29)) and days[28] == 1


def test_abs_hash_never_throws_and_ids(spark, ansi):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("k"))
    rows = df.select(H.abs_hash("k").alias("h"), H.keyed_id(1, "claim", "k", F.lit(1)).alias("i")).collect()
    assert all(r.h >= 0 or r.h == H.INT_MIN for r in rows)
    assert all(len(r.i) == 16 for r in rows)
    import hashlib

    assert rows[5].i == hashlib.sha256(b"1|claim|5|1").hexdigest()[:16]


def test_calendar_columns(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 1, 4),)], "d date")
    cal = C.calendar_columns("d")
    rows = df.select(*[v.alias(k) for k, v in cal.items()]).collect()
    assert (rows[0].date_sk, rows[0].year, rows[0].week_of_year, rows[0].is_weekend) == (20241230, 2024, 1, False)
    assert (rows[1].date_sk, rows[1].quarter, rows[1].is_weekend) == (20250104, 1, True)
