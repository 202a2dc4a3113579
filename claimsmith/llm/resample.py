"""Importance resampling of documents towards a target distribution.

1. Hashed n-gram features. Texts of the corpus and of the target are counted
   into a fixed number of buckets; each task sends its own histogram once.
2. A bucket's gain is the log ratio of its smoothed shares in the target and
   in the corpus. The gains form one array of as many entries as buckets.
3. A second pass scores every document against that array: its weight is the
   mean gain of its features.
4. Gumbel noise from a hash of the id turns "draw without replacement in
   proportion to exp(weight / 1000)" into "take the highest scores".
5. The ranks come from a distributed LSD radix sort of the composite key
   (score descending, id ascending); see :func:`radix_ranks`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch, Shared
from claimsmith.operators.keys import bounded_broadcast

BUCKETS = 10_000
LONGEST_RUN = 2
LEAST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
DIGIT_BITS = 11
#: Consecutive positions that one counting-sort group holds at most.
BLOCK_BITS = 12

#: Bytes of a text that are taken into words at once.
_BLOCK_BYTES = 1 << 20
_HELD_FEATURES = 1 << 20
#: Bytes of words as they are, A-Z lowered, all others a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_blocks(raw: bytes, size: int = _BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, in lists of about ``size`` bytes:
    runs of digits, letters a-z (A-Z lowered) and characters beyond ASCII."""
    clean, start = raw.translate(_WORD_BYTES), 0
    while start < len(clean):
        end = clean.find(b" ", start + size)
        end = len(clean) if end < 0 else end
        yield clean[start:end].split()
        start = end


def features(raw: bytes | None, longest: int = LONGEST_RUN, size: int = _BLOCK_BYTES) -> Iterator[tuple[int, list[int]]]:
    """(words, crc32 of features) block by block: all runs of 1 to ``longest``
    consecutive words joined by a space. The crc32 of a run goes on from that
    of the run without its last word, so no run is ever put together."""
    tail: list[bytes] = []
    for block in word_blocks(raw or b"", size):
        words = tail + block
        crcs = list(map(crc32, words))
        found = crcs[len(tail):]
        for n in range(2, longest + 1):  # runs that end in this block
            crcs = list(map(crc32, words[n - 1:], map(crc32, repeat(b" "), crcs)))
            found += crcs[max(0, len(tail) - n + 1):]
        tail = words[len(words) - min(len(words), longest - 1):]
        yield len(block), found


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without any are left out."""
    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(buckets, np.int64), []
        for batch in batches:
            for raw in batch.column(0):
                for _, found in features(raw.as_py(), longest):
                    held += found
                    if len(held) >= _HELD_FEATURES:
                        total += np.bincount(np.array(held, np.int64) % buckets, minlength=buckets)
                        held = []
        total += np.bincount(np.array(held, np.int64) % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    parts = texts.select(F.col(f"`{text_col}`").cast("binary")).mapInArrow(histogram, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Array of floor(1000 ln(target share / corpus share)) by bucket, shares
    smoothed by one. The driver gets one row per bucket, a fixed number."""
    t = np.zeros(buckets)
    s = np.zeros(buckets)
    for counts, into in ((corpus, s), (target, t)):
        for bucket, n in counts.select("bucket", "n").collect():
            into[bucket] = n
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def weights(text: Column, gains: Shared, longest: int = LONGEST_RUN) -> Column:
    """struct(n_words, n_features, weight): the weight is the floored mean gain of the features, 0 without any."""
    @F.arrow_udf("n_words bigint, n_features bigint, weight bigint")
    def weighed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = gains.value
        for texts in batches:
            rows = np.zeros((3, len(texts)), np.int64)
            for i, raw in enumerate(texts):
                for words, found in features(raw.as_py(), longest):
                    rows[:, i] += words, len(found), table[np.array(found, np.int64) % len(table)].sum()
            rows[2] //= np.maximum(rows[1], 1)
            yield pa.StructArray.from_arrays([pa.array(r) for r in rows], ["n_words", "n_features", "weight"])

    return weighed(text.cast("binary"))


def gumbel_noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of a hash of the id (null: of no text)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def _sort_key(value: Column, descending: bool, low: int | None, high: int | None) -> tuple[Column, int]:
    """A key whose unsigned order is the wanted order of a bigint between
    ``low`` and ``high``, and its number of bits."""
    if low is None:
        return F.lit(0).cast("bigint"), 0
    if high - low < 1 << 63:
        return F.lit(high) - value if descending else value - F.lit(low), (high - low).bit_length()
    return value.bitwiseXOR(F.lit((1 << 63) - 1 if descending else -(1 << 63))), 64


def radix_ranks(rows: DataFrame, order: list[tuple[str, bool]], out: str = "rank", digit_bits: int = DIGIT_BITS,
                block_bits: int = BLOCK_BITS) -> DataFrame:
    """The rows with their rank from 1 in the order of bigint columns
    ``order`` (name, descending), most significant first, by an LSD radix sort.

    Each digit of the composite key, from the least significant, is one
    stable counting sort. Rows stand at positions; a run of consecutive
    positions is a block. (block, digit) counts come from a partial sum per
    task. A row's destination is the number of rows with a smaller digit (one
    number per digit value), those with its digit in earlier blocks (a running
    sum along the blocks of each digit), and its place among the equal digits
    of its own block. The destinations are the next pass's positions, and the
    last pass's are the ranks. Counts and places are grouped by (block,
    digit), so rows are dealt once a pass, no group exceeds a block however
    often a value occurs, and no task or driver sees an order of all rows.

    Nulls come last in either direction. Rows alike in all of ``order`` take
    consecutive ranks; which of them comes first is not defined. An empty
    table gives no rows.
    """
    scratch = Scratch(rows.sparkSession, "radix")
    packed, digits = [F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")], []
    values = [F.col(f"`{name}`").cast("bigint") for name, _ in order]
    ends = rows.agg(*[f(v).alias(f"{f.__name__}{i}") for i, v in enumerate(values) for f in (F.min, F.max)],
                    *[F.max(v.isNull().cast("int")).alias(f"null{i}") for i, v in enumerate(values)]).first()
    for i, (value, (_, descending)) in enumerate(zip(values, order)):
        key, width = _sort_key(value, descending, ends[f"min{i}"], ends[f"max{i}"])
        packed += [value.isNull().cast("bigint").alias(f"n{i}"), F.coalesce(key, F.lit(0)).cast("bigint").alias(f"k{i}")]
        digits += [(f"n{i}", 0)] * (ends[f"null{i}"] or 0)
        digits += [(f"k{i}", shift) for shift in range(0, width, digit_bits)][::-1]
    # Positions of the first pass: any order will do, so that of partitions and their rows.
    held, path = scratch.write(rows.select(*packed).withColumn("at", F.monotonically_increasing_id()))
    for key, shift in digits[::-1] or [("k0", 0)]:
        digit = F.shiftrightunsigned(key, shift).bitwiseAND(F.lit((1 << digit_bits) - 1)).cast("int")
        placed = held.withColumn("digit", digit).withColumn("block", F.shiftright("at", block_bits))
        counts, counts_path = scratch.write(placed.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n")))
        smaller, below = [], 0
        for d, n in sorted(counts.groupBy("digit").agg(F.sum("n")).collect()):  # at most 2^digit_bits rows
            smaller.append((d, below))
            below += n
        before = bounded_broadcast(rows.sparkSession.createDataFrame(smaller, "of int, smaller bigint"), len(smaller))
        earlier = F.sum("n").over(Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
        starts = counts.withColumn("earlier", F.coalesce(earlier, F.lit(0))).join(before, F.col("digit") == F.col("of")).select(
            F.col("digit").alias("of_digit"), F.col("block").alias("of_block"), (F.col("smaller") + F.col("earlier")).alias("start"))
        place = F.row_number().over(Window.partitionBy("block", "digit").orderBy("at")) - 1
        moved = placed.withColumn("place", place).join(
            starts, (F.col("block") == F.col("of_block")) & (F.col("digit") == F.col("of_digit")))
        nxt, nxt_path = scratch.write(moved.select(*held.columns[:-1], (F.col("start") + F.col("place")).alias("at")))
        scratch.drop(path)
        scratch.drop(counts_path)
        held, path = nxt, nxt_path
    return held.select("row.*", (F.col("at") + 1).alias(out))


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, longest: int = LONGEST_RUN, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank.

    Of the documents with at least ``least_words`` words, ``percent`` of a
    hundred (rounded down) are drawn: those of the highest scores, ties to the
    smaller id, a null id last. ``rank`` counts them from 1 and is null for
    all others. Null and empty texts have no features and weight 0; rows
    repeated as a whole are documents of their own with the same score. An
    empty target or corpus leaves the smoothed shares of the other; an empty
    corpus gives no rows. Columns but doc_id and text are not read.
    """
    spark = docs.sparkSession
    gains = bucket_gains(bucket_counts(docs, "text", longest, buckets), bucket_counts(target, "text", longest, buckets), buckets)
    scored = docs.select("doc_id", weights(F.col("text"), Shared(spark, gains), longest).alias("w")).select("doc_id", "w.*")
    scored, _ = Scratch(spark, "resample").write(
        scored.withColumn("score", F.col("weight") + gumbel_noise(F.col("doc_id"), seed)))
    able = F.col("n_words") >= least_words
    ranked = radix_ranks(scored.where(able), [("score", True), ("doc_id", False)])
    drawn = scored.where(able).count() * percent // 100
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(
        scored.where(~able).withColumn("rank", F.lit(None).cast("bigint")))
