import random

import pytest
import xxhash

from claimsmith.llm import queries, simhash
from claimsmith.llm.components import connected_components
from tests.conftest import SF_SMALL


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union_find(pairs, nodes):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {n: root(n) for n in nodes}


def brute_components(prints):
    """prints: (id, fingerprint) -> {id: component}; ids may be None."""
    fps = sorted({f for _, f in prints})
    classes = union_find([(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 2], fps)
    least = {}
    for i, f in prints:
        if i is not None:
            least[classes[f]] = min(i, least.get(classes[f], i))
    return [(i, f, least.get(classes[f])) for i, f in prints]


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = sorted((i, f"{f:016x}", c) for i, f, c in brute_components(docs))
    got = queries.op3_simhash_near_dedup(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("dense_key", [0, 1, 64])
def test_links_of_random_close_fingerprints(spark, dense_key):
    rng = random.Random(5)
    centre = [rng.getrandbits(64) for _ in range(4)]
    fps = set(centre)
    for _ in range(400):
        f = rng.choice(sorted(fps))
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 2, 3)))))
    signed = [(simhash._signed(f),) for f in fps]
    got = {r["fp"]: r["class"] for r in simhash.fingerprint_classes(
        spark.createDataFrame(signed, "fp bigint"), 2, dense_key).collect()}
    back = lambda x: x % (1 << 64)
    want = union_find([(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2], fps)
    mine = {}
    for f in fps:
        mine.setdefault(back(got[simhash._signed(f)]), set()).add(f)
    theirs = {}
    for f in fps:
        theirs.setdefault(want[f], set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, " \t\n", None), (4, "One two", "z"), (5, "one  TWO", "z"), (5, "one  TWO", "z"),
            (None, "one two", "q"), (None, "alone here now then", None), (9, "É é " * 40000, "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    want = brute_components([(i, brute_fingerprint(t)) for i, t, _ in rows])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == sorted(want, key=key)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 4), (False, 9), (True, 0)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.close_pairs(spark.createDataFrame([(1,)], "fp bigint"), 3)


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 60)]
    noise = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(80)]
    pairs = chain + hub + noise + [(7, 7), (None, 3), (3, 2)]
    nodes = {n for a, b in pairs if a is not None and a != b for n in (a, b)}
    want = union_find([(a, b) for a, b in pairs if a is not None and a != b], nodes)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
