"""Substring de-duplication by MinHash banding of paragraphs.

A paragraph is a line of at least ``MIN_WORDS`` words (A-Z lowered, split at
white space). The steps:

1. One pass over the texts writes, per document, its paragraphs and its
   chosen runs (step 5). A paragraph new to the task comes with its words and
   the keys of ``BANDS`` bands of ``ROWS`` MinHashes of its 5-word shingles.
   Two paragraphs of Jaccard 0.8 share a band with probability
   1 - (1 - 0.8^3)^16 > 0.9999, of 0.69 (4 of 112 words replaced) with 0.998.
2. Paragraphs that share a key are joined with two centres of the key, its
   first and last in an order of the key's own; keys of up to three different
   paragraphs are thereby compared in full.
3. A pair is verified by the exact Jaccard similarity of the 5-word shingles
   (0.8 or more) or the exact word edit distance (at most 5 % of the longer).
4. What is similar to neither centre of a larger key gets a longer key, with
   ``MORE`` more MinHashes, and new centres; this goes on until nothing is apart.
   Every round is proportional to what is still apart, whatever a key holds.
   Verified links give classes by connected components. Centres only spare
   comparisons: paragraphs of a larger key that are then in different classes
   are compared exactly, by the rarest shingles that any similar pair must
   share (prefix filter), first with the unit of each shingle that near copies
   gather around, then, where classes still differ, with each other if the
   parities of their words or shingles allow it; what is found joins classes.
5. Passages are also copied into the middle of other paragraphs. Of each
   ``CHOICE`` neighbouring runs of ``RUN`` words the one with the smallest
   hash is chosen, so texts that share words choose the same runs. Shared runs
   outside repeated paragraphs, at most ``GAP_WORDS`` words apart, form
   stretches; those of ``MIN_STRETCH`` words are repeats.

A class, or a run, stays in its document with the smallest id and is marked
for removal elsewhere. Fewer than ``CHOICE`` words at a passage's edge may be
kept by another document, as a run there need not be chosen in every copy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch, shuffles_freed, utf8
from claimsmith.llm.components import connected_components

SHINGLE, SIMILARITY, EDITS = 5, 0.8, 0.05
MIN_WORDS, GAP_WORDS = 40, 14
RUN, CHOICE = 12, 10
#: What shared runs cover at least of 50 common words.
MIN_STRETCH = 50 - 2 * (CHOICE - 1)
ROWS, BANDS, MORE = 3, 16, 2
MAX_ROUNDS = 200
_BATCH_BYTES = 4 << 20
_CACHE = 400_000
_SEEN = 200_000
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M[1]
    x = (x ^ (x >> np.uint64(27))) * _M[2]
    return x ^ (x >> np.uint64(31))


def _salt(i: int) -> np.uint64:
    return _mix(np.array([i + 1], np.uint64) * _M[0])[0]


class WordHasher:
    """64-bit hashes of words, kept for the next texts."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, 0)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words (none, if there are fewer words)."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size if n else 0):
        out = out * _M[0] + hashes[k:n + k]
    return _mix(out)


def min_hash(shingles: np.ndarray, starts: np.ndarray, number: int) -> np.ndarray:
    return np.minimum.reduceat((shingles ^ _salt(number)) * _M[1], starts)


def band_keys(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(paragraphs x bands) keys of paragraphs whose shingles begin at ``starts``."""
    out = np.zeros((len(starts), BANDS), np.uint64)
    for b in range(BANDS if len(starts) else 0):
        key = np.full(len(starts), _salt(1_000_000 + b))
        for r in range(ROWS):
            key = _mix(key * _M[0] + min_hash(shingles, starts, b * ROWS + r))
        out[:, b] = key
    return out.view(np.int64)


def chosen_runs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the runs chosen from a text's word hashes."""
    runs = rolled(hashes, RUN)
    if len(runs) < CHOICE:
        return np.zeros(0, np.int64), runs[:0]
    near = np.lib.stride_tricks.sliding_window_view(runs, CHOICE)[:, ::-1]  # the last of equal ones
    at = np.unique(np.arange(CHOICE - 1, len(runs)) - near.argmin(1))
    return at, runs[at]


def paragraphs_of(text: bytes | None) -> tuple[list[bytes], list[tuple[int, int]]]:
    """All words and the word ranges of the paragraphs."""
    words: list[bytes] = []
    ranges = []
    for line in (text or b"").lower().split(b"\n"):
        own = line.split()
        if len(own) >= MIN_WORDS:
            ranges.append((len(words), len(words) + len(own)))
        words += own
    return words, ranges


_PARTS = ("doc_id bigint, runs array<bigint>, at array<int>, "
          "paragraphs array<struct<unit: bigint, first: int, end: int, keys: array<bigint>, words: binary>>")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paragraphs and chosen runs per document; keys and words with the first
    occurrence of a paragraph in the task only."""
    hasher, seen = WordHasher(), set()

    def lists(values: pa.Array, sizes: list[int]) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values)

    def rows(ids: pa.Array, texts: list[bytes | None]) -> pa.RecordBatch:
        runs, at, many, n_runs = [], [], [], []
        units, first, end, words_of = [], [], [], []
        fresh, fresh_at = [], []
        for text in texts:
            words, ranges = paragraphs_of(text)
            hashes = hasher.hashes(words)
            places, chosen = chosen_runs(hashes)
            runs.append(chosen)
            at.append(places)
            n_runs.append(len(places))
            many.append(len(ranges))
            for a, b in ranges:
                joined = b" ".join(words[a:b])
                unit = xxhash.xxh64_intdigest(joined, 7) - (1 << 63)
                new = unit not in seen
                if new:
                    seen.add(unit)
                    fresh.append(rolled(hashes[a:b], SHINGLE))
                    fresh_at.append(len(units))
                units.append(unit)
                first.append(a)
                end.append(b)
                words_of.append(joined if new else None)
        sizes = [len(s) for s in fresh]
        own = band_keys(np.concatenate(fresh) if fresh else np.zeros(0, np.uint64),
                        (np.cumsum(sizes) - sizes).astype(np.int64) if fresh else np.zeros(0, np.int64))
        has = np.zeros(len(units), np.int64)
        has[fresh_at] = BANDS
        keys = lists(pa.array(own.ravel()), has.tolist())
        if len(seen) > _SEEN:  # only spares repeated rows
            seen.clear()
        paragraphs = pa.StructArray.from_arrays(
            [pa.array(units, pa.int64()), pa.array(first, pa.int32()), pa.array(end, pa.int32()), keys,
             pa.array(words_of, pa.binary())], ["unit", "first", "end", "keys", "words"])
        return pa.RecordBatch.from_arrays(
            [ids, lists(pa.array(np.concatenate(runs).view(np.int64)), n_runs),
             lists(pa.array(np.concatenate(at).astype(np.int32)), n_runs), lists(paragraphs, many)],
            ["doc_id", "runs", "at", "paragraphs"])

    for batch in batches:
        sizes = pd.Series([len(t) if t else 0 for t in batch["text"].to_pylist()]).cumsum() // _BATCH_BYTES
        for _, part in sizes.groupby(sizes):
            own = batch.slice(part.index[0], len(part))
            yield rows(own["doc_id"], own["text"].to_pylist())


def edit_distance_within(a: list, b: list, most: int) -> bool:
    """Whether ``most`` insertions, deletions and replacements turn a into b;
    furthest reach per diagonal, so the work is bounded by most squared."""
    if abs(len(a) - len(b)) > most or sum((Counter(a) - Counter(b)).values()) > most:
        return False
    goal, reach = len(b) - len(a), {}
    for d in range(most + 1):
        now = {}
        for k in range(-d, d + 1):
            i = 0 if d == 0 else max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
            i = min(i, len(a), len(b) - k)
            if i < 0 or i + k < 0:
                continue
            while i < len(a) and i + k < len(b) and a[i] == b[i + k]:
                i += 1
            now[k] = i
        if now.get(goal, -1) >= len(a):
            return True
        reach = now
    return False


@lru_cache(32)  # pairs come sorted, a centre's next to each other
def _taken_apart(text: bytes) -> tuple[list[bytes], frozenset]:
    words = text.split()
    return words, frozenset(zip(*(words[k:] for k in range(SHINGLE))))


def similar(a: bytes, b: bytes) -> bool:
    """Jaccard of the 5-word shingles of 0.8 or more, or an edit distance of
    at most 5 % of the longer one's words."""
    (x, p), (y, q) = _taken_apart(a), _taken_apart(b)
    both = len(p & q)
    if both >= SIMILARITY * (len(p) + len(q) - both):
        return True
    return edit_distance_within(x, y, int(EDITS * max(len(x), len(y))))


def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similar(x, y) for x, y in zip(a, b)], dtype="bool")


def _longer_keys(number: int):
    """The key with MORE further MinHashes of the paragraph."""
    def keys(key: pd.Series, words: pd.Series) -> pd.Series:
        hasher, out = WordHasher(), []
        for w in words:
            shingles = rolled(hasher.hashes(w.split()), SHINGLE)
            out.append([min_hash(shingles, np.array([0]), number + i)[0] for i in range(MORE)])
        mixed = key.to_numpy(np.int64).view(np.uint64)
        for more in np.array(out, np.uint64).reshape(-1, MORE).T:
            mixed = _mix(mixed * _M[0] + more)
        return pd.Series(mixed.view(np.int64))

    return F.pandas_udf(keys, "bigint")


def verified_links(keys: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b) links between similar units of ``keys`` (key, unit), found by
    centres, and the rows (key, unit) of keys with several units; ``units``
    has (unit, words). Keys of up to three units are compared in full, larger
    ones see to ``paragraph_classes``."""
    scratch = Scratch(keys.sparkSession, "paragraph-links")
    alike = F.pandas_udf(_similar, "boolean")
    order = F.col("unit").bitwiseXOR(F.col("key"))
    links, level, old, first = None, 0, None, None
    while True:
        dealt = keys.repartition("key")  # one shuffle for the centres and for the rows that meet them
        centres = (dealt.groupBy("key").agg(F.min(order).alias("lo"), F.max(order).alias("hi")).where("lo != hi")
                   .select("key", F.col("lo").bitwiseXOR(F.col("key")).alias("lo"),
                           F.col("hi").bitwiseXOR(F.col("key")).alias("hi")))
        met, met_path = scratch.write(dealt.join(centres.hint("shuffle_hash"), "key"))
        pair = F.explode(F.array(*(F.struct(F.least("unit", c).alias("a"), F.greatest("unit", c).alias("b"))
                                   for c in ("lo", "hi")))).alias("p")
        pairs = met.select(pair).select("p.a", "p.b").where("a != b").distinct()
        a = units.select(F.col("unit").alias("a"), F.col("words").alias("wa"))
        b = units.select(F.col("unit").alias("b"), F.col("words").alias("wb"))
        found, _ = scratch.write(pairs.join(a, "a").join(b, "b").where(alike("wa", "wb")).select("a", "b"))
        links = found if links is None else links.unionByName(found)
        linked = found.select(F.col("a").alias("unit"), F.col("b").alias("c")).unionByName(
            found.select(F.col("b").alias("unit"), F.col("a").alias("c")))
        inner = met.where("unit != lo and unit != hi")
        for c in ("lo", "hi"):
            inner = inner.join(linked.withColumnRenamed("c", c), ["unit", c], "left_anti")
        apart, apart_path = scratch.write(inner.select("key", "unit"))
        if first is None:
            first = met.select("key", "unit")
        else:
            scratch.drop(met_path)
        if apart.isEmpty():
            for path in (apart_path, *(old or ())):
                scratch.drop(path)
            return links.distinct(), first
        if level == MAX_ROUNDS:
            raise RuntimeError("paragraphs of one key did not come apart")
        # The next round reads the words of what is apart only.
        units, words_path = scratch.write(units.join(apart.select("unit").distinct(), "unit", "left_semi"), "zstd")
        number = BANDS * ROWS + level * MORE
        level += 1
        keys, keys_path = scratch.write(
            apart.join(units, "unit").select(_longer_keys(number)("key", "words").alias("key"), "unit"))
        for path in (apart_path, *(old or ())):
            scratch.drop(path)
        old = (words_path, keys_path)


def parity(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits, each flipped by the values dealt to it: lists that differ in
    d values, repeats counted, differ in d bits at most."""
    odd = np.bincount((hashes & np.uint64(127)).astype(np.int64), minlength=128).astype(np.uint8) & 1
    return tuple(np.packbits(odd).view(np.int64).tolist())


_FEATURES = "struct<shingles: array<bigint>, n: bigint, w0: bigint, w1: bigint, s0: bigint, s1: bigint>"


def _features(words: pd.Series) -> pd.DataFrame:
    """The different shingles' hashes, the number of words, and the parities of words and shingles."""
    hasher, rows = WordHasher(), []
    for w in words:
        hashes = hasher.hashes(w.split())
        shingles = np.unique(rolled(hashes, SHINGLE))
        rows.append((shingles.view(np.int64), len(hashes), *parity(hashes), *parity(shingles)))
    return pd.DataFrame(rows, columns=["shingles", "n", "w0", "w1", "s0", "s1"])


def _differ(kind: str):
    return sum(F.bit_count(F.col(f"a.{kind}{i}").bitwiseXOR(F.col(f"b.{kind}{i}"))) for i in (0, 1))


def may_be_similar():
    """Whether rows a and b of ``similar_across`` may be of similar units.
    Jaccard: of the shingles of both a ninth at most is in one only. Edits:
    each changes two words at most."""
    pa, pb, na, nb = (F.col(c) for c in ("a.p", "b.p", "a.n", "b.n"))
    jaccard = (F.col("a.jaccard") & F.col("b.jaccard") & (F.least(pa, pb) * 5 >= F.greatest(pa, pb) * 4)
               & (_differ("s") * 9 <= pa + pb))
    edits = (F.col("a.edits") & F.col("b.edits") & (F.least(na, nb) * 20 >= F.greatest(na, nb) * 19)
             & (_differ("w") * 10 <= F.greatest(na, nb)))
    return jaccard | edits


def similar_across(rest: DataFrame, scratch: Scratch) -> DataFrame:
    """(ca, cb) links between classes of ``rest`` (unit, cls, words) that join
    all classes with similar units.

    Of p shingles and n words a similar paragraph shares 4/5 p at least, or all
    but the 5 that each of its edits (n / 19 at most, of the longer's 5 %) can
    break. So two similar ones, their shingles in one order, share one of the
    first p - that + 1 of either measure; the order is by frequency, rare ones
    first, as common passages would pair what is not alike. Shingles of one
    unit only count, they are not joined.

    Every unit first meets, for each of these shingles, the one of its units
    with the most common text, around which near copies gather. Only what is
    then in different classes meets each other, where ``may_be_similar``."""
    own, own_path = scratch.write(rest.select(
        "unit", "cls", F.pandas_udf(_features, _FEATURES)("words").alias("f")).select("unit", "cls", "f.*"), "zstd")
    marks = ["n", "w0", "w1", "s0", "s1"]
    p, n = F.col("p"), F.col("n")
    rows = own.select("unit", F.explode("shingles").alias("shingle"))
    common = own.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).where(
        "held > 1")
    ranked = rows.join(common, "shingle").groupBy("unit").agg(
        F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("s"), F.sum("held").alias("held")).join(
        own.select("unit", "cls", F.size("shingles").cast("bigint").alias("p"), *marks), "unit")
    # The unit's own shingles are the rarest and have the first places.
    jaccard, edits = p - F.ceil(p * 4 / 5) + 1, SHINGLE * F.floor(n / 19) + 1
    first = F.least(p, F.greatest(jaccard, edits))
    alone = p - F.size("s")
    prefix, prefix_path = scratch.write(ranked.select(
        "unit", "cls", "p", *marks, (F.col("held") / p).alias("common"), alone.alias("alone"),
        F.posexplode(F.slice("s", F.lit(1), F.greatest(first - alone, F.lit(0)).cast("int"))).alias("i", "x")).select(
        "unit", "cls", "p", *marks, "common", F.col("x.shingle").alias("shingle"),
        (F.col("alone") + F.col("i") < jaccard).alias("jaccard"), (F.col("alone") + F.col("i") < edits).alias("edits")))
    wa = rest.select(F.col("unit").alias("a"), F.col("words").alias("wa"))
    wb = rest.select(F.col("unit").alias("b"), F.col("words").alias("wb"))

    def verified(pairs: DataFrame) -> DataFrame:
        return scratch.write(pairs.distinct().join(wa, "a").join(wb, "b").where(
            F.pandas_udf(_similar, "boolean")("wa", "wb")).select("ca", "cb").distinct())[0]

    def met(a: DataFrame, b: DataFrame, differ) -> DataFrame:
        return a.alias("a").join(b.alias("b"), F.col("a.shingle") == F.col("b.shingle")).where(
            differ & (F.col("a.cls") != F.col("b.cls")) & may_be_similar()).select(
            *(F.col(x).alias(y) for x, y in (("a.unit", "a"), ("b.unit", "b"), ("a.cls", "ca"), ("b.cls", "cb"))))

    centres = prefix.groupBy("shingle").agg(F.max(F.struct("common", "unit", "cls", "p", *marks, "jaccard", "edits")).alias("c"))
    near = verified(met(prefix, centres.select("shingle", "c.*"), F.lit(True)))
    joined, joined_path = scratch.write(connected_components(near, "ca", "cb").select(F.col("node").alias("cls"), F.col("component").alias("to")))
    now = prefix.join(joined, "cls", "left").withColumn("cls", F.coalesce("to", "cls")).drop("to", "common")
    found = verified(met(now, now, F.col("a.unit") < F.col("b.unit"))).unionByName(near)
    for path in (own_path, prefix_path, joined_path):
        scratch.drop(path)
    return found


def paragraph_classes(keys: DataFrame, units: DataFrame, scratch: Scratch) -> DataFrame:
    """(unit, component) of units similar to another: all that share a key are
    compared, through centres or, where these leave classes of a key apart, by
    ``similar_across``. The component is the smallest unit."""
    links, met = verified_links(keys, units)
    classes, _ = scratch.write(connected_components(links).select(F.col("node").alias("unit"), "component"))
    held = met.join(classes, "unit", "left").select("key", "unit", F.coalesce("component", "unit").alias("cls"))
    mixed = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("lo"), F.max("cls").alias("hi")).where(
        "n > 3 and lo != hi").select("key")
    rest, rest_path = scratch.write(
        held.join(mixed, "key").select("unit", "cls").distinct().join(units, "unit").select("unit", "cls", "words"), "zstd")
    found = similar_across(rest, scratch)
    scratch.drop(rest_path)
    if found.isEmpty():
        return classes
    joined, _ = scratch.write(connected_components(found, "ca", "cb").select(F.col("node").alias("cls"), F.col("component").alias("to")))
    # A class is named by its smallest unit, so a unit that was alone stands for itself.
    alone = joined.join(classes, F.col("cls") == F.col("unit"), "left_anti").select(
        F.col("cls").alias("unit"), F.col("to").alias("component"))
    return classes.join(joined, F.col("component") == F.col("cls"), "left").select(
        "unit", F.coalesce("to", "component").alias("component")).unionByName(alone)


def stretches(runs: list, spans: list | None) -> list[tuple]:
    """(first_word, end_word, passage_first, passage_end, class, kept_in) of
    the words of shared runs (at, run, kept_in) outside the spans; a stretch
    goes over gaps of GAP_WORDS words and is cut where the keeping document
    changes."""
    runs = sorted((r["kept_in"], r["at"], r["run"]) for r in runs)  # a word goes with the smallest keeper
    first, end = min(r[1] for r in runs), max(r[1] for r in runs) + RUN
    owner = np.full(end - first, -1, np.int64)
    for i in range(len(runs) - 1, -1, -1):
        owner[runs[i][1] - first:runs[i][1] - first + RUN] = i
    for p in spans if spans is not None else ():
        owner[max(0, p["first"] - first):max(0, p["end"] - first)] = -2
    edges = np.flatnonzero(np.diff(np.concatenate([[False], owner >= 0, [False]]).astype(np.int8)))
    joined: list[list[int]] = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if joined and a - joined[-1][1] <= GAP_WORDS and (owner[joined[-1][1]:a] == -1).all():
            joined[-1][1] = b
        else:
            joined.append([a, b])
    keeper = np.array([r[0] for r in runs], np.int64)
    out = []
    for a, b in joined:
        if b - a < MIN_STRETCH:
            continue
        own = owner[a:b]
        last = np.maximum.accumulate(np.where(own >= 0, np.arange(b - a), 0))  # gap words go with the run before
        own = own[last]
        kept = keeper[own]
        cuts = [0, *(np.flatnonzero(np.diff(kept)) + 1).tolist(), b - a]
        for x, y in zip(cuts, cuts[1:]):
            out.append((first + a + x, first + a + y, first + a, first + b,
                        min(runs[i][2] for i in np.unique(own[x:y])), int(kept[x])))
    return out


def shared_stretches(parts: DataFrame, passages: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows like those of ``passages`` for shared runs that no passage covers."""
    runs = parts.select("doc_id", F.explode(F.arrays_zip("runs", "at")).alias("r")).select(
        "doc_id", F.col("r.runs").alias("run"), F.col("r.at").alias("at"))
    shared, _ = scratch.write(
        runs.groupBy("run").agg(F.min("doc_id").alias("kept_in"), F.max("doc_id").alias("most"))
        .where("kept_in != most").select("run", "kept_in"))
    own = (runs.join(shared, "run").groupBy("doc_id")
           .agg(F.collect_set(F.struct("at", "run", "kept_in")).alias("runs")))
    covered = passages.groupBy("doc_id").agg(
        F.collect_set(F.struct(F.col("first_word").alias("first"), F.col("end_word").alias("end"))).alias("spans"))

    def rows(runs: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(fields, r)) for r in stretches(a, b)] for a, b in zip(runs, spans)], dtype=object)

    fields = ["first_word", "end_word", "passage_first", "passage_end", "class", "kept_in"]
    found = F.pandas_udf(rows, f"array<struct<{', '.join(f'{f} bigint' for f in fields)}>>")
    return (own.join(covered, "doc_id", "left").select("doc_id", F.explode(found("runs", "spans")).alias("r"))
            .select("doc_id", "r.*").withColumn("removed", F.col("doc_id") != F.col("kept_in")))


def repeated_passages(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per repeated paragraph, or stretch of shared runs outside of
    them: doc_id, its words [first_word, end_word), the passage it belongs to
    [passage_first, passage_end), its class, the document that keeps the
    class, and whether it is removed here.

    Null and empty texts have no paragraphs. All rows of one id are one
    document, and rows without an id, which no result row could name, take no
    part; paragraphs that only one document holds are no repeats. A stretch's
    class is the smallest hash of its runs. Paragraphs are told apart by
    64-bit hashes. An empty table gives no rows. Other columns are not read.
    """
    with shuffles_freed(docs.sparkSession):
        return _passages(docs, text_col, Scratch(docs.sparkSession, "paragraphs"))


def _passages(docs: DataFrame, text_col: str, scratch: Scratch) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8(text_col).alias("text")).where(
        "doc_id is not null")
    parts, _ = scratch.write(texts.mapInArrow(_parts, _PARTS), "zstd")
    places = parts.select("doc_id", F.explode("paragraphs").alias("p")).select(
        "doc_id", "p.unit", F.col("p.first").cast("bigint").alias("first_word"),
        F.col("p.end").cast("bigint").alias("end_word"))
    fresh = parts.select(F.explode("paragraphs").alias("p")).where("p.words is not null")
    units, units_path = scratch.write(fresh.select("p.unit", "p.keys", "p.words").dropDuplicates(["unit"]), "zstd")
    keys = units.select(F.explode("keys").alias("key"), "unit")
    classes, _ = scratch.write(paragraph_classes(keys, units.select("unit", "words"), scratch))
    scratch.drop(units_path)
    # A class is held by several documents if its paragraphs are; a hot paragraph is combined before the shuffle.
    held = (places.groupBy("unit").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
            .join(classes, "unit", "left").withColumn("class", F.coalesce("component", "unit")))
    holders = held.groupBy("class").agg(F.min("lo").alias("kept_in"), F.max("hi").alias("most")).where("kept_in != most")
    repeated, _ = scratch.write(held.select("unit", "class").join(holders.select("class", "kept_in"), "class"))
    passages, _ = scratch.write(places.join(repeated, "unit").select(
        "doc_id", "first_word", "end_word", F.col("first_word").alias("passage_first"),
        F.col("end_word").alias("passage_end"), "class", "kept_in",
        (F.col("doc_id") != F.col("kept_in")).alias("removed")).distinct())
    return passages.unionByName(shared_stretches(parts, passages, scratch))
