import numpy as np
import pytest

from claimsmith.llm import queries, rabitq
from tests.conftest import SF_SMALL


def brute(rows, k=20, asked=lambda i: i % 20 == 0):
    """rows: (id, vector) -> {query: [(id, score)]}"""
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if asked(i):
            scores = np.einsum("ij,ij->i", np.tile(np.array(v, np.float64), (len(rows), 1)), matrix)
            by = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), scores[j]) for j in by]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(map(len, want.values()))


def test_query_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    vectors, want = dict(rows), brute(rows)
    got = collected(queries.op1_rabitq_neighbours(spark, SF_SMALL))
    assert recall(got, want) >= 0.99
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    for q, found in got.items():
        for i, s in found:
            assert s == pytest.approx(np.dot(np.array(vectors[q], float), np.array(vectors[i], float)), abs=1e-12)


@pytest.mark.parametrize("dim", [1, 5, 24, 100])
def test_recall_over_blocks_without_structure(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, (rng.standard_normal(dim) * rng.uniform(0.1, 3)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collected(rabitq.nearest(df, "vec_id % 20 = 0", block_bytes=40_000, query_bytes=4_000))
    assert recall(got, brute(rows)) >= 0.98


def test_error_bound_holds():
    rng = np.random.default_rng(0)
    vectors, queries_ = rng.standard_normal((2000, 64)).astype(np.float32), rng.standard_normal((50, 64)).astype(np.float32)
    centres, turn = rabitq.fit_centroids(vectors, 8), rabitq.rotation(64)
    codes, scalars = rabitq.encode(vectors, centres, turn)
    true = queries_ @ vectors.T
    for epsilon, share in ((1.9, 0.93), (3.5, 0.999)):
        guess, error = rabitq.Block(codes, scalars, centres, turn).estimate(queries_, epsilon)
        assert (np.abs(guess - true) <= error).mean() > share
    assert abs((guess - true).mean()) < 0.02  # unbiased


def test_default_bound_holds_for_nearly_all():
    rng = np.random.default_rng(0)
    vectors, queries_ = rng.standard_normal((2000, 64)).astype(np.float32), rng.standard_normal((50, 64)).astype(np.float32)
    centres, turn = rabitq.fit_centroids(vectors, 8), rabitq.rotation(64)
    guess, error = rabitq.Block(*rabitq.encode(vectors, centres, turn), centres, turn).estimate(queries_)
    assert (np.abs(guess - queries_ @ vectors.T) <= error).mean() > 0.999


def test_copies_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    one = rng.standard_normal(8).tolist()
    rows = [(i, one) for i in range(100)] + [(200 + i, rng.standard_normal(8).tolist()) for i in range(50)]
    bad = [(300, None), (320, [0.0] * 8), (340, [float("nan")] * 8), (360, [float("inf")] + [1.0] * 7), (380, [None] + [1.0] * 7),
           (400, [1.0, 2.0]), (None, one), (420, [])]
    extra = [(60, one)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + bad + extra], "vec_id long, embedding array<double>, rank int, v string")
    got, want = collected(rabitq.nearest(df, "vec_id % 20 = 0")), brute(rows)
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}
    assert rabitq.nearest(df.limit(0), "vec_id % 20 = 0").count() == 0
    few = rabitq.nearest(df.where("vec_id in (20, 21, 22)"), "vec_id % 20 = 0").collect()
    assert [(r.query_id, r.vec_id) for r in sorted(few)] == [(20, 21), (20, 22)]
