import random
import zlib

import numpy as np
import pytest

from claimsmith.llm import queries
from claimsmith.llm import toxicity as T

SF_TRAINED = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op4_toxicity(spark, SF_TRAINED).collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_TRAINED}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_TRAINED}/documents.parquet").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(rows[i].score, k) for i, k in marks.items() if rows[i].held_out]
    caught = sum(s >= 0.7 for s, k in held if k) / sum(k for _, k in held)
    wrong = sum(s >= 0.7 for s, k in held if not k) / sum(not k for _, k in held)
    assert caught > 0.85 and wrong < 0.01


def test_probabilities_sum_to_one():
    rng = random.Random(0)
    words = {"".join(rng.choices("abc", k=rng.randrange(1, 5))): (rng.randrange(9), rng.randrange(9)) for _ in range(60)}
    words = {w: n for w, n in words.items() if sum(n)}
    count = {}
    for w, by in words.items():
        for g in T.grams_of(w, 3):
            c = count.setdefault(g, [0, 0])
            c[0] += by[0]
            c[1] += by[1]
    backoff = T.SharedBackoff(count)
    for context in ("", "a", "^", "ab", "zz"):
        total = sum(backoff.probability(context + x) for x in "abc$")
        assert total + backoff.uniform * _left(backoff, context) == pytest.approx(1)
    ratios = T.Ratios(words, 3, 2.0)
    for w in [*words, "cab", "zzz", "abcabc"]:
        want = 0.0
        for g in T.grams_of(w, 3):
            p = []
            for k in (0, 1):
                t = sum(c[k] for h, c in count.items() if h[:-1] == g[:-1])
                kept = sum(max(c[k] - 2, 0) for h, c in count.items() if h[:-1] == g[:-1])
                low = backoff.probability(g[1:])
                p.append((max(count.get(g, [0, 0])[k] - 2, 0) + (t - kept) * low) / t if t else low)
            want += np.log(p[1] / p[0])
        assert ratios.of(w) == pytest.approx(want)


def _left(backoff, context):
    """The weight with which a context reaches the uniform distribution (whose one more symbol is unseen)."""
    own = 1.0
    while True:
        t = backoff.total[context]
        if t:
            left = sum(max(n - T.BACKOFF_DISCOUNT, 0) for g, n in backoff.kinds.items() if g[:-1] == context) / t
            own *= 1 - left
        if not context:
            return own
        context = context[1:]


def test_one_class_no_labels_and_odd_rows(spark):
    docs = spark.createDataFrame([(i, "some words here " * (i % 3), 0.5) for i in range(40)] + [(None, None, None), (99, "", 1.0)],
                                 "doc_id long, text string, toxicity double")
    labels = spark.createDataFrame([(i, 0) for i in range(20)] + [(None, 1), (21, None), (22, 7)], "doc_id long, toxic int")
    for own, want in ((labels, 0.0), (labels.limit(0), 0.0)):
        got = T.score_documents(docs, T.train(docs, own)).collect()
        assert len(got) == 42 and all(r.toxicity == want for r in got)
    assert T.score_documents(docs.limit(0), T.train(docs.limit(0), labels)).count() == 0


def test_small_sample_learns_a_marked_stem(spark):
    rng = random.Random(4)
    base = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    text = lambda toxic: " ".join(rng.choices(base, k=rng.randrange(5, 60)) + ["vile" + rng.choice(["", "ness", "st", "ly", "ling"])] * toxic)
    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(800)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, toxic int")
    model = T.train(docs, labels, fit_documents=150)
    scores = model.scores(["alpha beta " * 20, "alpha beta " * 20 + "vileness", "vileish alpha " + "beta gamma " * 10, "", None])
    assert scores[0] < 0.1 and scores[1] > 0.9 and scores[2] > 0.7 and scores[3] < 0.5 and scores[4] == scores[3]


def test_ids_of_text_learn_the_same(spark):
    docs = spark.createDataFrame([(str(i), f"alpha beta {'vileness' if i % 4 == 0 else 'gamma'}") for i in range(300)],
                                 "doc_id string, text string")
    labels = spark.createDataFrame([(str(i), int(i % 4 == 0)) for i in range(300)], "doc_id string, toxic int")
    model = T.train(docs, labels)
    scores = model.scores(["alpha beta vileness", "alpha beta gamma"])
    assert scores[0] > 0.9 and scores[1] < 0.1
