import hashlib
import math
import random
import re
import zlib

import pytest

from claimsmith.llm import queries
from claimsmith.llm import resample as R
from tests.conftest import SF_SMALL


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def buckets_of(text, longest=2, buckets=10_000):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute_force(docs, target, percent=25, least=20, longest=2, buckets=10_000, seed=7):
    """Rows by the contract, with Python's sort."""
    s, t = [0] * buckets, [0] * buckets
    for texts, into in (([x for _, x in docs], s), (target, t)):
        for text in texts:
            for b in buckets_of(text, longest, buckets):
                into[b] += 1
    all_s, all_t = float(sum(s)), float(sum(t))
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for name, text in docs:
        found = buckets_of(text, longest, buckets)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([name, len(found), weight, weight + noise, None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = queries.op13_importance_resampling(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert rows_of(got) == brute_force(docs, target)


@pytest.mark.parametrize("size", [1, 5, 64, 1 << 20])
@pytest.mark.parametrize("longest", [1, 2, 4])
def test_features_do_not_depend_on_blocks(size, longest):
    rng = random.Random(size * longest)
    alphabet = ["a", "B", "é", "漢字", " ", "\n", "-", "9", "\x7f", "\x00", "_", "word ", "  ", "\xa0", "\x85"]
    for _ in range(200):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        blocks = list(R.features(text.encode(), longest, size))
        assert sorted(c % 10_000 for _, found in blocks for c in found) == sorted(buckets_of(text, longest))
        assert sum(n for n, _ in blocks) == len(words(text))
    assert list(R.features(None)) == list(R.features(b"")) == []


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rng = random.Random(5)
    pool = ["alpha", "Beta", "gamma", "é", "7", "delta"]
    docs = [(i, " ".join(rng.choices(pool, k=rng.choice([0, 1, 19, 20, 25, 60])))) for i in range(-40, 160)]
    docs += [(500, None), (501, ""), (None, "alpha " * 30), (None, None), (7, "beta " * 22), (7, "beta " * 22)]
    docs += [(2**62, "gamma " * 40), (-(2**63), "delta " * 21)]
    docs += [(1000 + i, "alpha beta " * 20) for i in range(150)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, rank int, row string, at int")
    target = spark.createDataFrame([(1, "alpha beta"), (2, None), (3, "")], "item_id long, text string")
    got = R.resample(df.repartition(7), target, percent=60)
    assert rows_of(got) == brute_force(docs, ["alpha beta", None, ""], percent=60)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two " * 15)], "doc_id long, text string")
    none = docs.limit(0)
    assert R.resample(none, docs).count() == 0
    assert rows_of(R.resample(docs, none, percent=100)) == brute_force([(1, "one two " * 15)], [], percent=100)


@pytest.mark.parametrize("digit_bits,block_bits,wide", [(11, 12, True), (11, 5, False), (3, 0, False)])
def test_radix_ranks_equal_a_sort(spark, digit_bits, block_bits, wide):
    rng = random.Random(digit_bits)
    ends = [0, -1, 5, 2**63 - 1, -(2**63)] if wide else [0, 3]
    rows = [(rng.choice([None, *ends, rng.randrange(-6, 9)]), rng.randrange(-5, 6) if i % 3 else None, i % 4) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b int, k0 int").repartition(5)
    order = [("a", True), ("b", False)]
    got = [tuple(r) for r in R.radix_ranks(df, order, "place", digit_bits, block_bits).orderBy("place").collect()]
    assert [r[3] for r in got] == list(range(1, len(rows) + 1))
    assert sorted((r[:3] for r in got), key=str) == sorted((tuple(r) for r in df.collect()), key=str)
    keys = [(r[0] is None, -(r[0] or 0), r[1] is None, r[1] or 0) for r in got]
    assert keys == sorted(keys)


def test_a_hot_digit_is_counted_in_bounded_groups(spark):
    """One value in all rows: a group holds a block, not the value's rows."""
    df = spark.range(0, 3000, 1, 3).selectExpr("id", "0L as same")
    got = R.radix_ranks(df, [("same", False), ("id", True)], block_bits=5)
    assert [r["id"] for r in got.orderBy("rank").collect()] == list(range(2999, -1, -1))
