"""Data-quality operators Q1-Q12; results are a DataFrame, not driver lists.

The reference runs twelve driver-blocking ``count()`` jobs. Here:

* Q2-Q5 and Q8 are counted where the claims are, and the different claim ids
  in an aggregation of the ids alone (combined map-side, so one id shared by
  many rows costs nothing extra); Q7's and Q11's claim counts are the same number;
* an orphan count is one ``left_anti`` join of the different keys with their
  rows (a null foreign key is an orphan, as in the reference's
  left-join-and-filter form); Q6, Q9 and Q10 share it;
* all metrics meet in one tiny long-format table, pivoted into one row and
  turned into result rows with ``inline``: a single Spark job builds all
  eleven rows of ``all_check_rows``.

A check whose columns are absent from fact_claims fails and names them; the
others still run. Three-valued logic is the reference's: a null status or a
comparison with a null amount is not a violation by itself.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (reference configuration and check names).
ALLOWED_CLAIM_STATUS = ("approved", "pending", "rejected")
SEVERITY = "error"
FACT_CLAIM_TYPES = {
    "claim_sk": "bigint", "claim_id": "string", "patient_sk": "bigint", "provider_sk": "bigint",
    "treatment_sk": "bigint", "date_sk": "int", "billed_amount": "double", "reimbursed_amount": "double",
    "claim_status": "string",
}
EXPECTED_FACT_CLAIM_COLUMNS = tuple(FACT_CLAIM_TYPES)
CHECK_SCHEMA = "python_schema_fact_claims"
CHECK_UNIQUE = "python_claim_id_uniqueness"
CHECK_NOT_NULL = "python_fact_claims_mandatory_not_null"
CHECK_STATUS = "python_claim_status_enum"
CHECK_AMOUNTS = "python_amount_constraints"
CHECK_FK = "python_referential_integrity"
CHECK_ROWS = "python_row_count_reconciliation"
CHECK_SQL_AMOUNTS = "sql_reimbursed_le_billed"
CHECK_SQL_PATIENT = "sql_fact_claims_patient_fk"
CHECK_SQL_PROVIDER = "sql_fact_claims_provider_fk"
CHECK_SQL_TOTALS = "sql_reimbursement_claim_totals_match"
MANDATORY = ("claim_id", "patient_sk", "provider_sk", "treatment_sk", "date_sk")
AMOUNTS = ("billed_amount", "reimbursed_amount")

RESULT_COLUMNS = ("run_id", "run_date", "check_name", "status", "severity", "details", "checked_at")


def mandatory_null() -> Column:
    """any of claim_id and the four foreign keys is null."""
    return F.exists(F.array(*[F.col(c).isNull() for c in MANDATORY]), lambda x: x)


def bad_status(allowed: tuple[str, ...] = ALLOWED_CLAIM_STATUS) -> Column:
    """status outside the (lower-cased) allowed set; null is not counted."""
    return ~F.col("claim_status").isin([s.lower() for s in allowed])


def over_reimbursed() -> Column:
    """more reimbursed than billed."""
    return F.col("reimbursed_amount") > F.col("billed_amount")


def bad_amount() -> Column:
    """negative amounts or reimbursed above billed."""
    return (F.least(*AMOUNTS) < 0) | over_reimbursed()


def claim_metrics(fact_claims: DataFrame, allowed: tuple[str, ...] = ALLOWED_CLAIM_STATUS) -> DataFrame:
    """Q2-Q5, Q8 (and the claim count of Q7 and Q11): one row. The counts are
    taken where the claims are; only the claim ids are shuffled, to count the
    different ones (a null id is one)."""
    flags = {"nulls": mandatory_null(), "status": bad_status(allowed), "amounts": bad_amount(), "over": over_reimbursed()}
    counts = fact_claims.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(cond).alias(name) for name, cond in flags.items()])
    return _one_row([_rows_of(fact_claims.select("claim_id").distinct(), "unique"), counts])


def _long(wide: DataFrame) -> DataFrame:
    """(metric, value) rows of a one-row frame."""
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in wide.columns])))


def orphan_count(fact: DataFrame, dim: DataFrame, key: str, name: str = "v") -> DataFrame:
    """Fact rows whose key has no dimension row (null keys included).
    Rows are counted per key first (combined map-side, so one key of many rows
    costs nothing extra): only different keys are sorted to meet the dimension."""
    held = fact.groupBy(key).agg(F.count(F.lit(1)).alias("__held"))
    return held.join(dim.select(key), key, "left_anti").agg(F.coalesce(F.sum("__held"), F.lit(0)).alias(name))


def _rows_of(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _one_row(frames: Iterable[DataFrame]) -> DataFrame:
    """One-row frames side by side, by a union and an aggregation."""
    frames = list(frames)
    names = [c for f in frames for c in f.columns]
    union = _long(frames[0])
    for f in frames[1:]:
        union = union.unionByName(_long(f))
    return union.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


@dataclass(frozen=True)
class Check:
    """A named rule over the metrics: which are compared, and how details read."""

    name: str
    passed: Column
    details: Column
    needs: tuple[str, ...] = ()


def _fmt(template: str, *cols: str) -> Column:
    return F.format_string(template, *[F.col(c) for c in cols])


def _inline(wide: DataFrame, checks: list[Check], missing: list[str]) -> DataFrame:
    rows = []
    for c in checks:
        absent = [m for m in missing if m in c.needs]
        passed = F.lit(False) if absent else c.passed
        details = F.lit("not evaluated: missing_columns=" + ",".join(absent)) if absent else c.details
        rows.append(F.struct(
            F.lit(c.name).alias("check_name"), F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
            F.lit(SEVERITY).alias("severity"), details.alias("details")))
    return wide.select(F.inline(F.array(*rows)))


def _complete(fact_claims: DataFrame) -> tuple[DataFrame, list[str]]:
    """fact_claims with null columns in place of absent ones, and their names."""
    missing = sorted(set(EXPECTED_FACT_CLAIM_COLUMNS) - set(fact_claims.columns))
    return fact_claims.withColumns({c: F.lit(None).cast(FACT_CLAIM_TYPES[c]) for c in missing}), missing


def _python_checks(missing: list[str]) -> list[Check]:
    c = F.col
    return [
        Check(CHECK_SCHEMA, F.lit(not missing), F.lit("missing_columns=" + ",".join(missing) if missing else "ok")),
        Check(CHECK_UNIQUE, c("total") == c("unique"), _fmt("total=%d, unique=%d", "total", "unique"), ("claim_id",)),
        Check(CHECK_NOT_NULL, c("nulls") == 0, _fmt("violations=%d", "nulls"), MANDATORY),
        Check(CHECK_STATUS, c("status") == 0, _fmt("violations=%d", "status"), ("claim_status",)),
        Check(CHECK_AMOUNTS, c("amounts") == 0, _fmt("violations=%d", "amounts"), AMOUNTS),
        Check(CHECK_FK, F.greatest("fk_patient", "fk_provider", "fk_treatment") == 0,
              _fmt("fact_claims.patient_fk=%d, fact_claims.provider_fk=%d, fact_prescriptions.treatment_fk=%d",
                   "fk_patient", "fk_provider", "fk_treatment"), ("patient_sk", "provider_sk")),
        Check(CHECK_ROWS, (c("stg_claims") == c("total")) & (c("stg_prescriptions") == c("fact_prescriptions")),
              _fmt("stg_claims=%d, fact_claims=%d, stg_prescriptions=%d, fact_prescriptions=%d",
                   "stg_claims", "total", "stg_prescriptions", "fact_prescriptions")),
    ]


def _sql_checks() -> list[Check]:
    def none_of(name: str, metric: str, needs: tuple[str, ...] = ()) -> Check:
        return Check(name, F.col(metric) == 0, _fmt("fail_count=%d", metric), needs)

    return [none_of(CHECK_SQL_AMOUNTS, "over", AMOUNTS), none_of(CHECK_SQL_PATIENT, "fk_patient", ("patient_sk",)),
            none_of(CHECK_SQL_PROVIDER, "fk_provider", ("provider_sk",)), none_of(CHECK_SQL_TOTALS, "apart")]


def _claim_parts(fc: DataFrame, curated: dict[str, DataFrame], allowed: tuple[str, ...]) -> list[DataFrame]:
    return [claim_metrics(fc, allowed), orphan_count(fc, curated["dim_patient"], "patient_sk", "fk_patient"),
            orphan_count(fc, curated["dim_provider"], "provider_sk", "fk_provider")]


def _event_parts(curated: dict[str, DataFrame], staging: dict[str, DataFrame]) -> list[DataFrame]:
    rx = curated["fact_prescriptions"]
    return [orphan_count(rx, curated["dim_treatment"], "treatment_sk", "fk_treatment"), _rows_of(rx, "fact_prescriptions"),
            _rows_of(staging["stg_claims_events"], "stg_claims"),
            _rows_of(staging["stg_prescriptions_events"], "stg_prescriptions")]


def _total_part(curated: dict[str, DataFrame]) -> list[DataFrame]:
    return [curated["fact_reimbursements"].agg(F.coalesce(F.sum("total_claims"), F.lit(0)).alias("reimbursed_claims"))]


def _with_apart(wide: DataFrame) -> DataFrame:
    """How far the claim counts of the totals are from the claims."""
    return wide.withColumn("apart", F.abs(F.col("reimbursed_claims") - F.col("total")))


def python_check_rows(curated: dict[str, DataFrame], staging: dict[str, DataFrame],
                      allowed: tuple[str, ...] = ALLOWED_CLAIM_STATUS) -> DataFrame:
    """Q1-Q7 as rows (check_name, status, severity, details); always seven."""
    fc, missing = _complete(curated["fact_claims"])
    wide = _one_row([*_claim_parts(fc, curated, allowed), *_event_parts(curated, staging)])
    return _inline(wide, _python_checks(missing), missing)


def sql_check_rows(curated: dict[str, DataFrame]) -> DataFrame:
    """Q8-Q11 as rows; always four."""
    fc, missing = _complete(curated["fact_claims"])
    wide = _with_apart(_one_row([*_claim_parts(fc, curated, ALLOWED_CLAIM_STATUS), *_total_part(curated)]))
    return _inline(wide, _sql_checks(), missing)


def all_check_rows(curated: dict[str, DataFrame], staging: dict[str, DataFrame],
                   allowed: tuple[str, ...] = ALLOWED_CLAIM_STATUS) -> DataFrame:
    """Q1-Q11 from one set of metrics: each table and each orphan join once."""
    fc, missing = _complete(curated["fact_claims"])
    wide = _with_apart(_one_row([*_claim_parts(fc, curated, allowed), *_event_parts(curated, staging), *_total_part(curated)]))
    return _inline(wide, [*_python_checks(missing), *_sql_checks()], missing)


def run_sql_checks(spark: SparkSession, tables: dict[str, DataFrame], checks: dict[str, str]) -> DataFrame:
    """Q12: run named SQL texts that give one ``fail_count`` (null -> 0) each;
    ``{name}`` stands for a table. Spark binds the frames for the call, so no
    view is left behind."""
    out = None
    for name, text in checks.items():
        wide = spark.sql(text, **{k: v for k, v in tables.items() if "{" + k + "}" in text}).select(
            F.coalesce(F.col("fail_count").cast("bigint"), F.lit(0)).alias("fail_count"))
        rows = _inline(wide, [Check(name, F.col("fail_count") == 0, _fmt("fail_count=%d", "fail_count"))], [])
        out = rows if out is None else out.unionByName(rows)
    return out


def with_run_columns(rows: DataFrame, run_id: str, run_date: str, checked_at: datetime | None = None) -> DataFrame:
    """Adds run_id, run_date and a UTC checked_at (timestamp_ntz) to check rows."""
    ts = (checked_at or datetime.now(timezone.utc)).replace(tzinfo=None)
    return rows.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_date).alias("run_date"),
        "check_name", "status", "severity", "details",
        F.lit(ts).cast("timestamp_ntz").alias("checked_at"),
    )


class QualityCheckFailed(RuntimeError):
    pass


def raise_on_failures(results: DataFrame) -> None:
    """Optional gate (the reference never stops on a FAIL): raise listing the
    failed error-severity checks. Only failed rows reach the driver, at most
    one per check."""
    failed = results.where((F.col("status") == "FAIL") & (F.col("severity") == SEVERITY)).select(
        "check_name", "details").collect()
    if failed:
        raise QualityCheckFailed("; ".join(f"{r.check_name}: {r.details}" for r in failed))
