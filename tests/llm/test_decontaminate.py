import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from claimsmith.llm import decontaminate as D
from claimsmith.llm import queries
from claimsmith.llm.fm_index import FmIndex, suffix_array
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    """{doc index: (n_words, n_hit, sorted item ids)}"""
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i:i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        out.append((len(w), len(hit), sorted(found)))
    return out


def naive_suffixes(text):
    place = {p: i for i, p in enumerate(np.flatnonzero(text == 0))}
    key = lambda i: [(0, place[j]) if text[j] == 0 else (1, text[j]) for j in range(i, len(text))]
    return sorted(range(len(text)), key=key)


@pytest.mark.parametrize("seed", range(6))
def test_index_search_and_locate(seed):
    rng = np.random.default_rng(seed)
    text = np.concatenate([np.concatenate([np.tile(rng.integers(1, 4 + seed, rng.integers(0, 9)), rng.integers(1, 5)), [0]])
                           for _ in range(30)]).astype(np.int64)
    assert suffix_array(text).tolist() == naive_suffixes(text)
    index = FmIndex(text, 12, sample=4)
    for width in (1, 2, 3, 5):
        patterns = rng.integers(1, 12, (60, width))
        lo, hi = index.search(patterns)
        for p, a, b in zip(patterns, lo, hi):
            want = [i for i in range(len(text) - width + 1) if (text[i:i + width] == p).all()]
            assert sorted(index.locate(np.arange(a, b))) == want


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = sorted((d[0], n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0 and 20 * h >= n)
                  for d, (n, h, i) in zip(docs, brute(docs, items)))
    got = sorted(tuple(r) for r in queries.op6_benchmark_decontamination(spark, SF_SMALL).collect())
    assert got == want
    assert any(r[5] for r in got) and not all(r[5] for r in got)


@pytest.mark.parametrize("shard_words", [7, 40, 1 << 20])
def test_shards_and_long_documents(shard_words):
    rng = random.Random(shard_words)
    vocabulary = ["a", "b", "c", "É", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [("1", text(30)), ("2", "b"), ("3", "a b c"), ("4", ""), ("5", text(13))]
    docs = [(i, text(rng.choice((0, 1, 5, 60, 400))) + (" " + items[0][1] if i % 3 == 0 else "")) for i in range(25)]
    windows = D.Windows([(i, t.encode()) for i, t in items])
    series = pd.Series([t.encode() for _, t in docs])
    got = pd.concat(list(D.scan(iter([series[:9], series[9:]]), windows, shard_words)))
    hits = [sum(e - s for s, e in zip(a, b)) for a, b in zip(got.starts, got.ends)]
    assert list(zip(got.n_words, hits, got["items"])) == brute(docs, items)


def test_edge_rows_and_blocks(spark):
    rows = [(1, None, 5), (2, "", None), (None, "One two, THREE", 1), (4, "x " * 30 + "one two three", 2), (4, "one", 2),
            (7, "É" * 10 + " one two three " * 20, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, contamination int")
    items = [(1, "one two three"), (2, None), (None, "x x x"), (3, "..."), (1, "one two three"), (4, "x x"), (5, "É")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute([(r[0], r[1]) for r in rows], [i for i in items if i[0] is not None])
    for block in (1, 8, 1 << 20):
        got = D.mark_contamination(docs, bench, block_bytes=block).collect()
        assert [(r.contamination.n_words, r.contamination.n_hit, r.contamination["items"]) for r in got] == want
    assert D.mark_contamination(docs, bench.limit(0)).where("contamination.n_hit > 0").count() == 0
    assert D.mark_contamination(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("block", [8, 1 << 20])
def test_items_without_an_id_hit(spark, block):
    docs = spark.createDataFrame([(1, "say one two three now"), (2, "nothing"), (3, "four five six")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "one two three"), (7, "four five six"), (None, None)], "item_id long, text string")
    got = {r.doc_id: r.contamination for r in D.mark_contamination(docs, bench, block_bytes=block).collect()}
    assert [(got[i].n_hit, got[i]["items"]) for i in (1, 2, 3)] == [(3, []), (0, []), (3, ["7"])]


@pytest.mark.parametrize("seed", range(4))
def test_windows_of_a_block_are_the_distinct_ones(seed):
    rng = random.Random(seed)
    items = [(rng.choice([None, "a", "b", "c"]), " ".join(rng.choice("xyz") for _ in range(rng.choice((0, 1, 3, 13, 40)))))
             for _ in range(40)]
    want = {}
    for item, text in items:
        w = text.encode().split()
        for i in range(max(1, len(w) - 12) if w else 0):
            want.setdefault(tuple(w[i:i + 13]), set()).update({item} - {None})
    windows = D.Windows([(i, t.encode()) for i, t in items])
    word = {v: k for k, v in windows.ids.items()}
    got = {}
    for size, starts, cuts, whose in windows.by_length:
        for p, a, b in zip(windows.patterns(size, starts), cuts, cuts[1:]):
            assert tuple(p) not in got
            got[tuple(word[x] for x in p)] = {windows.names[i] for i in whose[a:b]}
    assert got == want


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_long_items_in_pieces_and_clashing_columns(spark, monkeypatch, block):
    monkeypatch.setattr(D, "PIECE_WORDS", 5)
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice((3, 13, 14, 90))))) for i in range(12)]
    docs = [(i, items[i % 12][1][2 * (i % 5):] + " " + " ".join(rng.choice("abcdefgh") for _ in range(30)), "m", "k")
            for i in range(30)]
    docs += [(99, docs[3][1], "m", "k")] * 5
    df = spark.createDataFrame(docs, "doc_id long, text string, mark string, Key string")
    got = D.mark_contamination(df, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    assert got.columns == [*df.columns, "contamination"]
    shown = sorted((r.doc_id, r.mark, r.Key, r.contamination.n_words, r.contamination.n_hit, r.contamination["items"])
                   for r in got.collect())
    assert shown == sorted((d[0], "m", "k", *w) for d, w in zip(docs, brute([d[:2] for d in docs], items)))
