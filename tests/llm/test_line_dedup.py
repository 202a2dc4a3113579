import hashlib
import random
from collections import defaultdict

from claimsmith.llm import line_dedup as L
from claimsmith.llm import queries
from tests.conftest import SF_SMALL

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(docs, least):
    """docs: distinct (id, text) -> sorted (id, n_lines, n_dropped, kept text)"""
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add((i, text))
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) and len(holders[key(x)]) >= least)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = order((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs, 10))
    got = queries.op7_line_dedup(spark, SF_SMALL).collect()
    assert order((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == want
    assert any(r[2] for r in want)


def test_random_lines_edges_and_hot_line(spark):
    rng = random.Random(2)
    pool = ["", " ", "A", "a", " a\t", " a", "É", "é", "b\r", "long line here", "HOT", "\x0bhot", "\x1fx"]
    docs = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 9)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "\n"), (None, "A\nhot"), (None, "b"), (103, "u " * 50000 + "\nhot")]
    df = spark.createDataFrame([(*d, 1) for d in docs + docs[:3]], "doc_id long, text string, n_lines int")
    for least in (2, 5, 40):
        got = L.apply_bitmaps(df, L.keep_bitmaps(df, least))
        got = got.select("doc_id", "n_lines", "n_dropped", L.kept_text(got["text"], got["keep"]).alias("kept")).collect()
        want = brute(docs, least)
        assert order(tuple(r) for r in got) == order(want + want[:3])
    assert L.keep_bitmaps(df.limit(0)).count() == 0


def test_a_line_counts_once_for_an_id(spark):
    """Nine ids, one of them with two texts: nine documents hold the line."""
    docs = [(i, f"shared\nown {i}") for i in range(9)] + [(0, "shared\nother"), (20, "shared?")]
    df = spark.createDataFrame([(*d, "a", "b") for d in docs], "doc_id long, text string, __id string, __t string")
    got = L.apply_bitmaps(df, L.keep_bitmaps(df, 10))
    assert got.columns == ["doc_id", "text", "__id", "__t", "n_lines", "n_dropped", "keep"]
    assert [r.n_dropped for r in got.collect()] == [0] * 11
    assert sorted(r.n_dropped for r in L.apply_bitmaps(df, L.keep_bitmaps(df, 9)).collect()) == [0] + [1] * 10


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = L.apply_bitmaps(docs, L.keep_bitmaps(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
