import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from claimsmith.llm import divergence as D
from claimsmith.llm import queries
from tests.conftest import SF_SMALL


def terms_of(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, least=10, top=10):
    """Rows by the contract, every term of every pair."""
    found, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source, terms = lang or "", source or "", terms_of(text)
        groups[lang].add(source)
        found[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in found[lang].items() if n >= least)

        def shares(count):
            mass = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // mass for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        share = {s: shares(counts[lang, s]) for s in sources}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s in sources:
            p = share[s]
            pairs = [(sum(f(p[t], share[o][t]) for t in kept), o) for o in sources - {s}]
            own = [(f(p[t], whole[t]), t) for t in kept if counts[lang, s][t] and p[t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", own, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def rows_of(df):
    assert df.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(map(tuple, df.collect()))


def test_query_equals_sql_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang", "source").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = sorted(con.sql(queries.OP12_SQL).fetchall())
    assert rows_of(queries.op12_source_divergence(spark, SF_SMALL)) == want == brute_force([tuple(d) for d in docs])


WORDS = ["the", "The", "of", "é", "É", "漢字", "a1b", "x_y", "don't", "zeta", "mu", "nu", "ß", "\x00q", "Ω", "ω"]


@pytest.mark.parametrize("fan_in,block,shard", [(512, 400_000, 1 << 26), (2, 30, 500)])
def test_small_blocks_and_many_rounds(spark, monkeypatch, fan_in, block, shard):
    rng = random.Random(8)
    docs = []
    for i in range(260):
        source = rng.choice([None, "", "hot", "hot", "hot", "b", "\U0001F600", "�"])
        docs.append((" ".join(rng.choices(WORDS, k=rng.randrange(25))), rng.choice(["en", "en", "fr", None, ""]), source))
    docs += [("unique words only", "rare", "a"), ("others here", "rare", "b"), (None, "rare", "c"), ("alone " * 30, "one", "s")] + [
        ("same row", "twin", "t")] * 11 + [("", "twin", "u")]
    monkeypatch.setattr(D, "SHARD_BYTES", shard)
    monkeypatch.setattr(D.merge_runs, "__defaults__", (fan_in,))
    monkeypatch.setattr(D.spill_runs, "__defaults__", (block,))
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "text string, lang string, source string, rank int, term string")
    assert rows_of(D.source_divergence(df.repartition(6))) == brute_force(docs)


def test_empty(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert rows_of(D.source_divergence(df)) == []
    one = spark.createDataFrame([(None, None, None)], df.schema)
    assert rows_of(D.source_divergence(one)) == []


def test_runs_and_merges_keep_every_posting(monkeypatch):
    monkeypatch.setattr(D, "_SLICE_TERMS", 3)
    rng, want, slices = random.Random(1), defaultdict(Counter), []
    for run in range(4):
        block = D.Block()
        for _ in range(20):
            text, source = " ".join(rng.choices([w for w in WORDS if "\x00" not in w], k=9)), rng.choice("uvw")
            block.add(text.encode(), "en", source)
            for term in terms_of(text):
                want[term][source] += 1
        slices += [b for b in block.run(run, 2)]
    rng.shuffle(slices)
    got = {}
    for shard in (0, 1):
        held = D.RunSlices(pa.Table.from_batches([b for b in slices if b.column(1)[0].as_py() == shard]))
        last = b""
        for terms, _, ends, sources, counts in held.merged(0):
            for term, a, b in zip(terms, [0, *ends], ends):
                assert last < term and term not in got
                last = term
                got[term] = {held.names[s]: n for s, n in zip(sources[a:b].tolist(), counts[a:b].tolist())}
    assert {t.decode(): c for t, c in got.items()} == want


def test_shares_are_exact_for_large_counts():
    rng = random.Random(2)
    mass = [rng.randrange(3, 9 * 10**15) for _ in range(500)]
    counts = [rng.randrange(0, m - 1) for m in mass]
    want = [1 + 10**9 * (c + 2) // m for c, m in zip(counts, mass)]
    assert D.share(np.array(counts), np.array(mass)).tolist() == want


@pytest.mark.parametrize("cells", [1, 7, 1000])
def test_corrections_do_not_depend_on_blocks(cells):
    rng = np.random.default_rng(6)
    n, rows = 9, [np.flatnonzero(rng.random(9) < 0.4) for _ in range(60)]
    sources, ends = np.concatenate(rows), np.cumsum([len(r) for r in rows])
    counts, mass = rng.integers(1, 50, len(sources)), rng.integers(4000, 9000, n)
    total = Counter()
    for a, b, value in D.corrections(sources, ends, counts, mass, cells):
        assert (a < b).all()
        for x in zip(a.tolist(), b.tolist(), value.tolist()):
            total[x[:2]] += x[2]
    dense = np.zeros((len(rows), n), np.int64)
    dense[np.repeat(np.arange(len(rows)), [len(r) for r in rows]), sources] = counts
    p, none = D.share(dense, mass), D.share(np.zeros(n, np.int64), mass)
    for a in range(n):
        for b in range(a + 1, n):
            assert total[a, b] == D.divergence(p[:, a], p[:, b]).sum() - len(rows) * D.divergence(none[a], none[b])
