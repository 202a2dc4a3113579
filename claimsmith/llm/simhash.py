"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint's 64 bits are cut into ``max_bits + 2`` blocks. Two fingerprints
that differ in at most ``max_bits`` bits agree in at least two blocks, so each
distinct fingerprint is keyed once for every pair of blocks, fingerprints are
joined on those keys, and the Hamming distance of each candidate is verified.

A key under which many fingerprints meet (a large group of near copies) is
not expanded into its pairs. There each member is keyed by itself with up to
``max_bits / 2`` of the bits outside the two shared blocks flipped: members
within the distance meet under at least one such variant, and all that meet
under one variant are within the distance of each other, so linking them to
their smallest member loses no link. A variant has a bounded number of
members, so no group grows with the data. Both ways are exact; their border
``dense_key`` only decides which one is cheaper.

Exact copies share a fingerprint and are reduced to it before any join.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch, utf8
from claimsmith.llm.components import connected_components

SEED = 42
BITS = 64
DENSE_KEY = 64
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The SimHash of a text as a signed 64-bit integer; no words: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    grams = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, len(words) - width + 1)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i:i + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_column(text: str, shingle: int) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return F.pandas_udf(run, "bigint")(utf8(text))


def _blocks(max_bits: int) -> list[int]:
    """Bit masks of max_bits + 2 blocks that cover all bits."""
    n = max_bits + 2
    cuts = [BITS * i // n for i in range(n + 1)]
    return [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def close_pairs(prints: DataFrame, max_bits: int, dense_key: int = DENSE_KEY) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: every pair within
    ``max_bits`` bits is linked, directly or through members of one variant;
    no other pair is linked."""
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even and not negative")
    scratch = Scratch(prints.sparkSession, "simhash-keys")
    masks = [x | y for x, y in combinations(_blocks(max_bits), 2)]
    keyed, _ = scratch.write(prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.key"))
    met = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared, _ = scratch.write(keyed.join(met, ["t", "key"]))
    few = shared.where(F.col("n") <= dense_key)
    pairs = (few.select("t", "key", F.col("fp").alias("a")).join(few.select("t", "key", F.col("fp").alias("b")), ["t", "key"])
             .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
             .select("a", "b"))
    flips = [[0, *(_signed(sum(c)) for r in range(1, max_bits // 2 + 1)
                   for c in combinations([1 << i for i in range(BITS) if not m >> i & 1], r))] for m in masks]
    at = F.element_at(F.lit(flips).cast("array<array<bigint>>"), F.col("t") + 1)
    many = shared.where(F.col("n") > dense_key).select("fp", F.explode(at).alias("flip"))
    stars = (many.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
             .agg(F.collect_set("fp").alias("m")).where(F.size("m") > 1)
             .select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
             .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)))
    return pairs.unionByName(stars).distinct()


def fingerprint_classes(prints: DataFrame, max_bits: int, dense_key: int = DENSE_KEY) -> DataFrame:
    """(fp, class) for every distinct fingerprint; the class is the smallest
    fingerprint (as a signed number) that links reach."""
    distinct, _ = Scratch(prints.sparkSession, "simhash-prints").write(prints.select("fp").distinct())
    found = connected_components(close_pairs(distinct, max_bits, dense_key))
    return (distinct.join(found, distinct["fp"] == found["node"], "left")
            .select("fp", F.coalesce("component", "fp").alias("class")))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", dense_key: int = DENSE_KEY) -> DataFrame:
    """One row per document: its id, fingerprint (``fp`` bigint) and
    component id, the smallest id reachable over links.

    Null and empty texts have fingerprint 0 and are linked like any other.
    Repeated rows stay repeated. A null id is never the smallest; the
    component of documents that all have null ids is null. An empty table
    gives no rows. Only the id and the text are read.
    """
    prints, _ = Scratch(docs.sparkSession, "simhash-docs").write(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col, shingle).alias("fp")))
    classes = fingerprint_classes(prints, max_bits, dense_key)
    named = prints.groupBy("fp").agg(F.min("id").alias("first")).join(classes, "fp")
    least = named.groupBy("class").agg(F.min("first").alias("component_id"))
    of = named.join(least, "class").select("fp", "component_id")
    return prints.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents table with one row of each group of near-duplicates: the
    one with the smallest doc_id (null ids last; the first read on ties)."""
    stamped, _ = Scratch(docs.sparkSession, "simhash-stage").write(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                    F.monotonically_increasing_id().alias("row"), fingerprint_column("text", shingle).alias("fp")))
    classes = fingerprint_classes(stamped, max_bits)
    rank = F.struct(F.col("id").isNull(), "id", "row")
    best = (stamped.select("fp", "row", F.col("doc.doc_id").alias("id"))
            .groupBy("fp").agg(F.min(rank).alias("best")).join(classes, "fp")
            .groupBy("class").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row")))
    return stamped.join(best, "row").select("doc.*")
