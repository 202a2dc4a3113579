"""Deterministic ids and hash-derived attributes.

sha256-based ids are portable (any SQL engine with sha256 reproduces them).
Murmur3 ``hash`` is Spark's own and is type-sensitive: seeds must stay
IntegerType literals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
INT_MIN = -2147483648
FALLBACK_REGION_ID = "R11"
HOSPITAL_TYPE_PATTERN = "hospital|hopital|clinique|clinic"
BIRTH_YEAR_BASE, BIRTH_YEAR_SPAN = 1940, 55
REGISTRATION_YEAR_BASE, REGISTRATION_YEAR_SPAN = 2018, 6
DISCHARGE_MAX_DAYS = 5
DIAGNOSIS_PREFIX, DIAGNOSIS_BASE, DIAGNOSIS_SPAN = "D", 100, 900
ID_HEX_CHARS = 16
CATEGORY_ID_HEX_CHARS = 12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def source_row_key(*parts: Column | str) -> Column:
    """D2: '|'-joined key of an aggregate row; null parts are skipped."""
    return F.concat_ws("|", *[_col(p) for p in parts])


def keyed_id(seed: int, kind: str, key: Column | str, seq: Column | str | None = None) -> Column:
    """D3: first 16 hex chars of sha256('seed|kind|key[|seq]')."""
    parts = [F.lit(str(seed)), F.lit(kind), _col(key)]
    if seq is not None:
        parts.append(_col(seq))
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, ID_HEX_CHARS)


def category_id(category: Column | str) -> Column:
    """First 12 hex chars of sha256(category)."""
    return F.substring(F.sha2(_col(category), 256), 1, CATEGORY_ID_HEX_CHARS)


def abs_hash(*cols: Column | str) -> Column:
    """abs(hash(...)) with legacy overflow: INT_MIN stays INT_MIN (never throws)."""
    h = F.hash(*[_col(c) for c in cols])
    return F.when(h == F.lit(INT_MIN), h).otherwise(F.abs(h))


def hash_sample(id_col: Column | str, seed: int, threshold: int, buckets: int = 10) -> Column:
    """deterministic sample, pmod(abs(hash(id, seed)), 10) < threshold."""
    # F.lit keeps Spark's literal width (int when the seed fits, else bigint),
    # which the hash depends on.
    return F.pmod(abs_hash(_col(id_col), F.lit(int(seed))), F.lit(buckets)) < F.lit(threshold)


def hospital_like(provider_type: Column | str) -> Column:
    """hospital-like provider type (null counts as not)."""
    return F.lower(F.coalesce(_col(provider_type), F.lit(""))).rlike(HOSPITAL_TYPE_PATTERN)


def patient_attributes(patient_id: Column | str) -> dict[str, Column]:
    """Gender, birth and registration dates from one Murmur3 hash."""
    h = abs_hash(patient_id)
    month = F.pmod(h, F.lit(12)) + 1
    day = F.pmod(h, F.lit(28)) + 1
    return {
        "gender": F.when(F.pmod(h, F.lit(2)) == 0, F.lit("F")).otherwise(F.lit("M")),
        "birth_date": F.make_date(F.lit(BIRTH_YEAR_BASE) + F.pmod(h, F.lit(BIRTH_YEAR_SPAN)), month, day),
        "registration_date": F.make_date(
            F.lit(REGISTRATION_YEAR_BASE) + F.pmod(h, F.lit(REGISTRATION_YEAR_SPAN)), month, day
        ),
    }


def discharge_offset(claim_id: Column | str) -> Column:
    """1..5 days after admission."""
    return F.pmod(abs_hash(claim_id), F.lit(DISCHARGE_MAX_DAYS)) + 1


def diagnosis_code(patient_id: Column | str) -> Column:
    """D13: 'D' + three digits 100..999 from the patient hash."""
    n = F.pmod(abs_hash(patient_id), F.lit(DIAGNOSIS_SPAN)) + DIAGNOSIS_BASE
    return F.concat(F.lit(DIAGNOSIS_PREFIX), F.lpad(n.cast("string"), 3, "0"))
