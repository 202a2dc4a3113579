import math
import zlib
from collections import Counter

import numpy as np
import pytest

from claimsmith.llm import class_lm as C
from claimsmith.llm import queries
from tests.conftest import SF_SMALL


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*low.encode().split(), b"\n"]


def remainder(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7


def brute_base(docs):
    counts = Counter(t for i, text in docs if remainder(i) != 2 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in docs:
        own = tokens(text)
        out.append((i, remainder(i) == 2, len(own), sum(counts[t] > 0 for t in own), n,
                    sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)))
    return out


def brute_score(docs, items, of):
    """The class model from its definition, given the items' classes."""
    train = [tokens(t) for i, t in docs if remainder(i) != 2]
    counts = Counter(t for d in train for t in d)
    cls = lambda t: int(of[items.of([t])[0]])
    k = int(of.max()) + 1
    pairs = Counter()
    for d in train:
        for a, b in zip([b"\n", *d], d):
            pairs[cls(a), cls(b)] += 1
    rows = [sum(pairs[a, b] for b in range(k)) for a in range(k)]
    kinds = [sum(pairs[a, b] > 0 for b in range(k)) for a in range(k)]
    total = sum(rows)
    share = [(sum(pairs[a, b] for a in range(k)) + 1) / (total + k) for b in range(k)]
    size = [1 + sum(c + 1 for t, c in counts.items() if cls(t) == b) for b in range(k)]
    out = []
    for _, text in docs:
        own, s = tokens(text), 0.0
        for a, b in zip([b"\n", *own], own):
            x, y = cls(a), cls(b)
            p = (pairs[x, y] + kinds[x] * share[y]) / (rows[x] + kinds[x]) if rows[x] else share[y]
            s += math.log10(p) + math.log10((counts[b] + 1) / size[y])
        out.append(s)
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op8_class_lm(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for i, held, n, known, total, base in brute_base(docs):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # a lower perplexity than the base


@pytest.mark.parametrize("hot_words", [0, 3, 1000])
def test_scores_equal_the_definition(spark, monkeypatch, hot_words):
    docs = [(i, " ".join(["the cat", "sat on", "The dog", "ran"][(i * 7 + j) % 4] + f" w{(i * j) % 11}ing" for j in range(i % 6)))
            for i in range(60)] + [(70, None), (71, ""), (72, "neverseen " * 3), (None, "the end"), (5, "the cat sat")]
    seen = {}
    fit = C.exchange
    monkeypatch.setattr(C, "exchange", lambda b, c: seen.setdefault("of", fit(b, c)))
    choose = C.choose_items
    monkeypatch.setattr(C, "choose_items", lambda *a: seen.setdefault("items", choose(*a)))
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double")
    got = C.score_documents(df, core=6, endings=3, classes=4, hot_words=hot_words).collect()
    base, score = brute_base(docs), brute_score(docs, seen["items"], seen["of"])
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted((tuple(r) for r in got), key=key)
    want = sorted(((*b, s) for b, s in zip(base, score)), key=key)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_exchange_finds_alternating_classes():
    rng = np.random.default_rng(0)
    a, b = np.arange(1, 8), np.arange(8, 15)
    table = np.zeros((15, 15), np.int64)
    for _ in range(4000):
        x, y = rng.choice(a), rng.choice(b)
        table[x, y] += 1
        table[y, rng.choice(a)] += 1
    of = C.exchange(table, 3)
    assert of[0] == 0 and len(set(of[a])) == 1 and len(set(of[b])) == 1 and of[1] != of[8]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert C.score_documents(df).count() == 0
    held = next(i for i in range(99) if remainder(i) == 2)
    only = spark.createDataFrame([(held, "a b")], df.schema)
    r = C.score_documents(only).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)
    assert math.isfinite(r.score)


def test_no_ending_is_left_to_the_rest(spark):
    """Words of 400 endings beyond the core; every one has an item, and with it a class of its own choice."""
    endings = [a + b for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    docs = [(i, " ".join(f"w{i}{e}" for e in endings)) for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counts = C.word_counts(df.selectExpr("cast(text as binary) as text"))
    items = C.choose_items(counts, 4)
    assert len(items.endings) == 400
    assert not (items.of([f"x{e}".encode() for e in endings]) == items.rest).any()
    big = C.item_bigrams(df.selectExpr("cast(text as binary) as text"), items)
    assert big.size == items.size and big.n.sum() == 3 * 401
    assert (C.transitions(big, C.exchange(big, 8)) < 0).all()


def test_sparse_exchange_equals_dense():
    rng = np.random.default_rng(4)
    table = rng.poisson(0.6, (30, 30))
    first, second = np.nonzero(table)
    big = C.Bigrams(30, first, second, table[first, second])
    of = C.exchange(big, 5)
    assert (of == C.exchange(table, 5)).all()
    member = np.eye(5)[of]
    assert (big.classes(of, 5) == member.T @ table @ member).all()


@pytest.mark.parametrize("hot_words", [0, 5, 1000])
def test_every_training_word_takes_a_class_by_itself(spark, monkeypatch, hot_words):
    """Words of one ending that stand in different places; scores equal the definition over the classes of the words."""
    docs = [(i, " ".join(f"the {['ant', 'bee', 'cow'][(i + j) % 3]}xx runs{(i * j) % 3}yy" for j in range(1 + i % 5)) + " zeldomyy once" * (i == 3))
            for i in range(40)] + [(70, None), (71, ""), (72, "never seenyy the"), (None, "the antxx"), (5, "the beexx")]
    seen = {}
    model, fit, choose = C.word_classes, C.exchange, C.choose_items
    monkeypatch.setattr(C, "exchange", lambda b, c: seen.setdefault("of", fit(b, c)))
    monkeypatch.setattr(C, "choose_items", lambda *a: seen.setdefault("items", choose(*a)))

    def classes(train, counts, items, of, moves, emission, alone):
        out = model(train, counts, items, of, moves, emission, alone)
        if alone:
            seen.update(words={bytes(r.word): (r.c, r.k) for r in out.collect()}, moves=moves, emission=emission)
        return out

    monkeypatch.setattr(C, "word_classes", classes)
    monkeypatch.setattr(C, "_HELD_NEIGHBOURS", 8)  # a word's occurrences come in many rows
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = C.score_documents(df, core=2, classes=5, hot_words=hot_words).collect()
    items, of, words = seen["items"], seen["of"], seen["words"]
    train = [tokens(t) for i, t in docs if remainder(i) != 2]
    counts = Counter(t for d in train for t in d)
    assert {w: c for w, (c, _) in words.items()} == counts  # each training word once
    by_item = lambda t: int(of[items.of([t])[0]])
    for w, (c, k) in words.items():
        if w in items.words:
            assert k == by_item(w)
            continue
        likely = np.zeros(len(seen["emission"]))
        for d in train:
            for a, b, e in zip([b"\n", *d], d, [*d[1:], b"\n"]):
                if b == w:
                    likely += seen["moves"][:, by_item(e)] + seen["moves"][by_item(a)] - seen["emission"]
        assert k > 0 and likely[k] == pytest.approx(likely[1:].max(), rel=1e-9)
    # Words of one ending are no longer held together: the order of likelihood may part them.
    own = type("Own", (), {"of": lambda self, ts: np.array([list(words).index(t) if t in words else len(words) + (by_item(t)) for t in ts])})()
    table = np.array([k for _, k in words.values()] + list(range(int(of.max()) + 1)))
    want = sorted(zip([b[:5] for b in brute_base(docs)], brute_score(docs, own, table)), key=lambda x: (str(x[0]), x[1]))
    have = sorted(((tuple(r)[:5], r.score) for r in got), key=lambda x: (str(x[0]), x[1]))
    for (g, s), (w, t) in zip(have, want, strict=True):
        assert g == w and s == pytest.approx(t, rel=1e-9)


def test_words_of_one_ending_part_by_their_neighbours(spark):
    """"redxx" and "runxx" share an item, but one follows "the" and the other a name."""
    docs = [(i, "the redxx dog . anna runxx home . the bluexx cat . bert sitsxx here .") for i in range(30)]
    train = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("cast(text as binary) as text")
    counts = C.word_counts(train)
    items = C.Items([b"the", b"anna", b"bert", b"dog", b"home", b"cat", b"here", b"."], [b"xx"])
    of = np.array([0, 1, 2, 2, 3, 4, 3, 4, 5, 3, 1])
    moves = C.transitions(C.item_bigrams(train, items), of)
    found = {bytes(r.word): r.k for r in C.word_classes(train, counts, items, of, moves, np.zeros(6), True).collect()}
    assert len(found) == 13 and found[b"redxx"] == found[b"bluexx"] and found[b"runxx"] == found[b"sitsxx"]
    assert {bytes(r.word): r.k for r in C.word_classes(train, counts, items, of, moves, np.zeros(6), False).collect()}[b"runxx"] == 3
