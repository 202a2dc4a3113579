import re
from collections import defaultdict

import pytest

from claimsmith.llm import mixing, queries
from tests.conftest import SF_SMALL


def water_fill(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by the contract's own rounds; sizes: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if rest * w[s] / total > cap * sizes[s]}
        if not over:
            target.update({s: rest * w[s] / total for s in free})
            break
        for s in over:
            target[s] = cap * sizes[s]
        rest -= sum(target[s] for s in over)
        free -= over
    return target


def check(rows, docs):
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, source, text in docs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    target = water_fill(sizes)
    assert sorted((r.doc_id or -1, r["size"]) for r in rows) == sorted(
        (i or -1, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, _, t in docs)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r["size"] * r.copies
        taken[r.source] += r.taken
    return {s: (taken[s], target[s], largest[s]) for s in sizes}


def test_query_meets_targets(spark):
    docs = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = queries.op2_source_mixing(spark, SF_SMALL).collect()
    for got, want, largest in check(rows, docs).values():
        assert abs(got - want) <= largest
    again = queries.op2_source_mixing(spark, SF_SMALL).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_hot_small_and_null_sources(spark):
    docs = [(i, "hot", "w " * (i % 7)) for i in range(600)] + [(1000 + i, f"s{i}", "a b c d") for i in range(12)]
    docs += [(2000, None, "one two"), (None, None, "three"), (2001, "", None), (2002, "\U0001F600", "x y z"), (2003, "�", "q")]
    docs += [(3000, "same", "u v")] * 40
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, source string, text string, target string, hash int")
    rows = mixing.mix(df).collect()
    report = check(rows, docs)
    for got, want, largest in report.values():
        assert abs(got - want) <= largest
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    copies = defaultdict(int)
    for r in rows:
        copies[r.doc_id] += r.copies
    seen = defaultdict(int)
    for r in mixed.collect():
        seen[r.doc_id] += 1
    assert seen == {k: v for k, v in copies.items() if v}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(df).count() == 0
    assert mixing.mixed_documents(df).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, "b", " ")], df.schema)
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_one_hash_per_level_is_refined(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL_BITS", 12)
    docs = [(i, "a", "w w w") for i in range(9000)] + [(9000 + i, "b", "w " * 9) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    for got, want, largest in check(mixing.mix(df).collect(), docs).values():
        assert abs(got - want) <= largest


def test_copies_of_one_row_meet_the_target(spark):
    docs = [(1, "a", "w " * 10)] * 200 + [(2, "b", "v " * 5)] * 7 + [(3 + i, "b", "v u") for i in range(5)]
    df = spark.createDataFrame([(*d, {"k": 1}, i % 3) for i, d in enumerate(docs)],
                               "doc_id long, source string, text string, m map<string,int>, ordinal int")
    rows = mixing.mix(df).collect()
    for got, want, largest in check(rows, docs).values():
        assert abs(got - want) <= largest / 2  # the nearest number of copies
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    taken = sum(r["size"] * r.copies for r in rows)
    assert sum(len(r.text.split()) for r in mixed.collect()) == taken
    again = mixing.mixed_documents(df).collect()
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again))
