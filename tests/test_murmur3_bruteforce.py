"""Brute-force check of the Murmur3-based synthesis (D11-D13) on a small fixture.

Spark's ``hash`` (Murmur3 x86 32-bit, seed 42, strings hashed 4 bytes at a
time with the remaining bytes mixed one by one, columns chained through the
seed) is restated here in plain Python, independent of Spark, and every
patient attribute and visit of the golden sample is recomputed row by row.
"""

import datetime as dt

import pytest

from claimsmith.operators import clean as CL
from claimsmith.operators import synthesize as D
from tests import golden as G

MASK = 0xFFFFFFFF


def _rotl(x, r):
    return ((x << r) | (x >> (32 - r))) & MASK


def _mix_k1(k1):
    k1 = (k1 * 0xCC9E2D51) & MASK
    k1 = _rotl(k1, 15)
    return (k1 * 0x1B873593) & MASK


def _mix_h1(h1, k1):
    h1 ^= k1
    h1 = _rotl(h1, 13)
    return (h1 * 5 + 0xE6546B64) & MASK


def _fmix(h1, length):
    h1 ^= length
    h1 ^= h1 >> 16
    h1 = (h1 * 0x85EBCA6B) & MASK
    h1 ^= h1 >> 13
    h1 = (h1 * 0xC2B2AE35) & MASK
    h1 ^= h1 >> 16
    return h1


def _signed(x):
    return x - (1 << 32) if x & 0x80000000 else x


def hash_string(s: str, seed: int) -> int:
    data = s.encode("utf-8")
    h1 = seed & MASK
    aligned = len(data) - len(data) % 4
    for i in range(0, aligned, 4):
        h1 = _mix_h1(h1, _mix_k1(int.from_bytes(data[i:i + 4], "little")))
    for b in data[aligned:]:
        signed_byte = b - 256 if b > 127 else b
        h1 = _mix_h1(h1, _mix_k1(signed_byte & MASK))
    return _signed(_fmix(h1, len(data)))


def hash_int(v: int, seed: int) -> int:
    return _signed(_fmix(_mix_h1(seed & MASK, _mix_k1(v & MASK)), 4))


def spark_hash(*values) -> int:
    h = 42
    for v in values:
        h = hash_string(v, h) if isinstance(v, str) else hash_int(v, h)
    return h


def abs_legacy(h: int) -> int:
    return h if h == -(1 << 31) else abs(h)


def test_python_murmur3_equals_spark(spark):
    from pyspark.sql import functions as F

    words = ["", "a", "ab", "abc", "abcd", "abcde", "é", "0123456789abcdef", "claim|x|ß|7"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: (r.h, r.hs) for r in df.select("w", F.hash("w").alias("h"),
                                                F.hash(F.col("w"), F.lit(20260308)).alias("hs")).collect()}
    assert got == {w: (spark_hash(w), spark_hash(w, 20260308)) for w in words}


@pytest.fixture(scope="module")
def golden_events(spark):
    claims = CL.clean_claims_agg(G.frame(spark, G.CLAIMS))
    rx = CL.clean_prescriptions_agg(G.frame(spark, G.PRESCRIPTIONS))
    providers = CL.clean_providers(G.frame(spark, G.PROVIDERS))
    ce = D.synthesize_claim_events(claims, G.GOLDEN_SEED)
    pe = D.synthesize_prescription_events(rx, G.GOLDEN_SEED)
    return ce, pe, providers


def test_patients_brute_force(golden_events):
    ce, pe, providers = golden_events
    region_of = {r.provider_id: r.region_id for r in providers.collect()}
    expected = {}
    for r in ce.select("patient_id", "provider_id").collect() + pe.select("patient_id", "provider_id").collect():
        h = abs_legacy(spark_hash(r.patient_id))
        region = region_of.get(r.provider_id)
        prev = expected.get(r.patient_id, (None,))[0]
        region = min(x for x in (prev, region) if x is not None) if (prev or region) else None
        month, day = h % 12 + 1, h % 28 + 1
        expected[r.patient_id] = (region, "F" if h % 2 == 0 else "M", dt.date(1940 + h % 55, month, day),
                                  dt.date(2018 + h % 6, month, day))
    expected = {k: (v[0] or "R11",) + v[1:] for k, v in expected.items()}
    got = {r.patient_id: (r.region_id, r.gender, r.birth_date, r.registration_date)
           for r in D.synthesize_patients(ce, pe, providers).collect()}
    assert len(got) == 259 and got == expected


def test_visits_brute_force(golden_events):
    ce, _, providers = golden_events
    kind = {r.provider_id: r.provider_type for r in providers.collect()}
    expected = {}
    for r in ce.collect():
        hospital = any(w in (kind.get(r.provider_id) or "").lower() for w in ("hospital", "hopital", "clinique",
                                                                               "clinic"))
        picked = abs_legacy(spark_hash(r.claim_id, G.GOLDEN_SEED)) % 10 < 3
        if hospital or picked:
            days = abs_legacy(spark_hash(r.claim_id)) % 5 + 1
            code = "D" + str(abs_legacy(spark_hash(r.patient_id)) % 900 + 100).rjust(3, "0")
            expected[r.claim_id] = (r.claim_date, r.claim_date + dt.timedelta(days=days), code)
    got = {r.claim_id: (r.admission_date, r.discharge_date, r.diagnosis_code)
           for r in D.synthesize_visits(ce, providers, G.GOLDEN_SEED, 3).collect()}
    assert len(got) == 85 and got == expected
