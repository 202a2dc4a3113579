"""Connected components over an edge table by alternating star contraction.

Each round points the larger neighbours of every node to its smallest
neighbour (large star), then the smaller ones (small star). The number of
rounds grows with the logarithm of the component size, each round is a fixed
number of equi-joins and partial aggregations, and its edges are written to
the shared checkpoint folder, so a lost executor re-reads them. Minima are
combined before the shuffle; the join back on a hub is left to the skew
handling of adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch

MAX_ROUNDS = 60


def _write(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    """Write edges; their number and the sum of their hashes, observed during
    the write, tell whether a round changed them."""
    seen = Observation()
    table, path = scratch.write(edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("h")))
    return table, path, (seen.get["n"], seen.get["h"])


def _star_round(edges: DataFrame) -> DataFrame:
    """One large star, then one small star, over edges (x > y)."""
    both = edges.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(
        edges.select(F.col("y").alias("u"), F.col("x").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("k"), F.least("u", "m").alias("m"))
    large = (both.join(least, F.col("u") == F.col("k")).where("v > u")
             .select(F.col("v").alias("x"), F.col("m").alias("y")).distinct())
    low = large.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("k"), "m")
    hung = large.join(low, F.col("x") == F.col("k"))
    return (hung.select(F.explode(F.array(F.struct("x", F.col("m").alias("y")),
                                          F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e"))
            .select("e.x", "e.y").where("x > y").distinct())


def connected_components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the pairs; the component is its
    smallest node. Pairs holding null, self pairs and repeated pairs add
    nothing; no pairs give no rows."""
    scratch = Scratch(pairs.sparkSession, "components")
    edges, path, seen = _write(scratch, pairs.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).distinct())
    for _ in range(MAX_ROUNDS if seen[0] else 0):
        edges, new, now = _write(scratch, _star_round(edges))
        scratch.drop(path)
        path = new
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError("components did not settle")
    # Settled edges are stars: every node that is not a root has one edge, to its root.
    return (edges.select(F.explode(F.array(F.struct(F.col("x").alias("node"), F.col("y").alias("component")),
                                           F.struct(F.col("y").alias("node"), F.col("y").alias("component")))).alias("e"))
            .select("e.node", "e.component").distinct())
