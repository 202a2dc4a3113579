"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Index. Vectors are assigned to the nearest of a few centroids (k-means on a
bounded sample), their residuals are rotated by a fixed random orthogonal
matrix, and each rotated coordinate keeps its sign: one bit. With the bits
goes one correction scalar, the inner product of the unit residual and its
code, and the residual's length. Every vector is indexed. The index is a table
of blocks, each a bounded number of codes with the original vectors.

Search. A query's inner product with a vector is its product with the
centroid plus an estimate from the packed bits, which is unbiased and whose
error exceeds ``epsilon`` standard bounds with a known small probability. In
each block a query first reranks the vectors with the best estimates exactly;
the weakest score found is then the bar, and every further vector whose upper
bound reaches it is reranked too. All scores returned are exact, in double
precision.

Queries are a set stated by the caller, itself cut into blocks; each cell of
(query block, vector block) is a row of one equi-join and fits in a task's
memory. Each cell keeps ``k`` rows per query, and the best of those are taken
with a windowed limit that also runs before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch
from claimsmith.operators.keys import dedup_keep_smallest

#: Bounds of estimates, in standard errors: all but a few of ten thousand hold.
EPSILON = 3.5
CENTROIDS = 32
SAMPLE_ROWS = 8192
BLOCK_BYTES = 16 << 20
QUERY_BYTES = 1 << 20
_STRIP = 64
SEED = 7

INDEX_SCHEMA = "block int, n int, dim int, ids binary, codes binary, scalars binary, vectors binary"


def usable_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) with v array<double>. Vectors that are null, empty, zero,
    or hold null or non-finite components, and rows without an id, take no
    part; of vectors of several lengths, the most frequent length (the
    greater one on ties) takes part. Of several rows of one id the smallest
    vector counts."""
    v = F.col(vector_col).cast("array<double>")
    rows = table.where(F.col(id_col).isNotNull() & v.isNotNull()).select(
        F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0))
    best = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return dedup_keep_smallest(rows.where(F.size("v") == (best["dim"] if best else 0)), ["vec_id"])


def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def fit_centroids(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """k-means on a bounded sample; few vectors give few centroids."""
    count = max(1, min(count, len(sample) // 16))
    centres = sample[np.random.default_rng(SEED).choice(len(sample), count, replace=False)]
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(1) - 2 * sample @ centres.T, axis=1)
        for c in range(count):
            if (near == c).any():
                centres[c] = sample[near == c].mean(0)
    return centres.astype(np.float32)


def encode(vectors: np.ndarray, centres: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits, and per vector (centroid, residual length, <unit residual, code>)."""
    near = np.argmin((centres**2).sum(1) - 2 * vectors @ centres.T, axis=1)
    residual = (vectors - centres[near]) @ turn
    length = np.linalg.norm(residual, axis=1)
    signs = residual > 0
    fit = np.abs(residual).sum(1) / np.sqrt(vectors.shape[1]) / np.where(length > 0, length, 1)
    scalars = np.stack([near, length, np.where(length > 0, fit, 1)], axis=1).astype(np.float32)
    return np.packbits(signs, axis=1, bitorder="little"), scalars


class Block:
    """The codes of a block of vectors, unpacked for one search."""

    def __init__(self, codes: np.ndarray, scalars: np.ndarray, centres: np.ndarray, turn: np.ndarray):
        self.dim, self.centres, self.turn = len(turn), centres, turn
        self.bits = np.unpackbits(codes, axis=1, count=self.dim, bitorder="little").astype(np.float32)
        self.near, length, fit = scalars[:, 0].astype(np.int64), scalars[:, 1], scalars[:, 2]
        self.scale = length / fit
        self.spread = length * np.sqrt(np.maximum(0, 1 - fit**2)) / fit / np.float32(np.sqrt(max(1, self.dim - 1)))

    def estimate(self, queries: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products (queries x vectors) and bounds of their errors."""
        turned = queries @ self.turn
        # <code, q> with code = (2 bits - 1) / sqrt(dim)
        guess = turned @ self.bits.T
        guess *= 2
        guess -= turned.sum(1, keepdims=True)
        guess *= self.scale / np.float32(np.sqrt(self.dim))
        guess += (queries @ self.centres.T)[:, self.near]
        size = np.linalg.norm(queries, axis=1)[:, None].astype(np.float32)
        # Plus what single precision can add.
        return guess, size * (np.float32(epsilon) * self.spread + 1e-5 * (self.scale + 1))


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, block: Block,
                 k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, vector ids, scores): each query's k nearest of the block.

    The best estimates of small groups of vectors are reranked first; the
    weakest of the k best scores is the bar for the upper bounds of all.
    """
    group = max(1, min(32, len(ids) // (4 * k)))
    whole = len(ids) // group * group
    place = {v: i for i, v in enumerate(ids.tolist())}
    exact = lambda q, v: np.einsum("ij,j->i", vectors[v], queries[q])
    for at in range(0, len(queries), _STRIP):
        guess, error = block.estimate(queries[at:at + _STRIP].astype(np.float32))
        for r in range(len(guess)):
            q, upper = at + r, guess[r] + error[r]
            own = place.get(int(query_ids[q]))
            if own is not None:
                upper[own] = guess[r, own] = -np.inf
            best = guess[r, :whole].reshape(-1, group)
            size = min(len(best), 4 * k)
            groups = np.argpartition(-best.max(1), size - 1)[:size]
            first = groups * group + best[groups].argmax(1)
            scores = exact(q, first[np.isfinite(guess[r, first])])
            if len(scores) >= k:
                v = np.flatnonzero(upper >= np.partition(scores, -k)[-k])
            else:
                v = np.flatnonzero(upper > -np.inf)
            scores = exact(q, v)
            if len(v) > k:
                top = scores >= np.partition(scores, -k)[-k]
                v, scores = v[top], scores[top]
            by = np.lexsort((ids[v], -scores))[:k]
            if len(by):
                yield int(query_ids[q]), ids[v[by]], scores[by]


def nearest(table: DataFrame, query_filter, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            centroids: int = CENTROIDS, sample_rows: int = SAMPLE_ROWS, block_bytes: int = BLOCK_BYTES,
            query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every usable
    vector that ``query_filter`` (a condition on vec_id) selects, among all
    other usable vectors; ties go to the smaller vec_id. Fewer candidates
    give fewer rows; an empty table gives none. The sample that centroids are
    fitted on has at most ``sample_rows`` vectors, the ones with the smallest
    hash; it only shapes the codes, all vectors are indexed and searched.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "rabitq")
    rows, _ = scratch.write(usable_vectors(table, id_col, vector_col))
    count, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    n_queries = rows.where(query_filter).count()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not n_queries:
        return empty
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(sample_rows).select("v").toPandas()["v"]
    centres = fit_centroids(np.stack(sample.to_list()).astype(np.float32), centroids)
    blocks = max(1, -(-count * dim * 8 // block_bytes))
    query_blocks = max(1, -(-n_queries * dim * 8 // query_bytes))

    def index(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(frame["v"].to_list())
        codes, scalars = encode(vectors.astype(np.float32), centres, rotation(vectors.shape[1]))
        row = (int(frame["block"].iloc[0]), len(frame), vectors.shape[1], frame["vec_id"].to_numpy(np.int64).tobytes(),
               codes.tobytes(), scalars.tobytes(), vectors.tobytes())
        return pd.DataFrame([row], columns=[c.split()[0] for c in INDEX_SCHEMA.split(", ")])

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(int(frame["part"].iloc[0]), frame["vec_id"].to_numpy(np.int64).tobytes(),
                              np.stack(frame["v"].to_list()).tobytes())], columns=["part", "qids", "queries"])

    indexed, _ = scratch.write(
        rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        .groupBy("block").applyInPandas(index, INDEX_SCHEMA))
    asked, _ = scratch.write(
        rows.where(query_filter).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
        .groupBy("part").applyInPandas(pack, "part int, qids binary, queries binary"))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = rotation(dim)
        for frame in frames:
            for c in frame.itertuples(index=False):
                read = lambda raw, kind, width: np.frombuffer(raw, kind).reshape(-1, width)
                block = Block(read(c.codes, np.uint8, -(-dim // 8)), read(c.scalars, np.float32, 3), centres, turn)
                found = list(search_block(
                    np.frombuffer(c.qids, np.int64), read(c.queries, np.float64, dim), np.frombuffer(c.ids, np.int64),
                    read(c.vectors, np.float64, dim), block, k))
                if found:
                    yield pd.DataFrame({"query_id": np.repeat([q for q, _, _ in found], [len(v) for _, v, _ in found]),
                                        "vec_id": np.concatenate([v for _, v, _ in found]),
                                        "score": np.concatenate([s for _, _, s in found])})

    cells = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(indexed, "block")
    found = cells.repartition(blocks * query_blocks, "block", "part").mapInPandas(
        search, "query_id bigint, vec_id bigint, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
