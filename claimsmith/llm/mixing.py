"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash of its id and text. A source's budget is a number
of whole passes over it plus a rest, and the rest is filled by the documents
whose hash lies below a threshold. The threshold comes from sums of words by
source and hash bucket: buckets before the one in which the budget ends are
taken whole, and only that bucket is split into finer buckets, until it holds
one hash. No table is sorted, and a document's fate is a comparison, so a
larger budget always keeps what a smaller one took. Where the one hash is that
of several rows alike in id and text, these are numbered and the first ones
taken.

Driver and joins see one row per source and level; sources are broadcast only
when their exact count shows that they fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.llm.common import WORD_RE, Scratch
from claimsmith.operators.keys import add_surrogate_key, bounded_broadcast, group_row_number

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
LEVEL_BITS, LEVELS = 12, 5
HASH_BITS = LEVEL_BITS * LEVELS


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_RE)), F.lit(0)).cast("bigint")


def mix_hash(doc_id: str, text: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.col(text)), 64 - HASH_BITS)


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights
    repeat along the sources by code point, null last; a target above ``cap``
    times its source's size stops there, and the excess is shared by weight
    among the others until none is above."""
    ranked = add_surrogate_key(sources.select(F.col("source").isNull().alias("last"), "source", "source_size"),
                               "rank", ["last", "source"])
    weighed = ranked.select(
        "source", "source_size", (F.col("source_size") * F.lit(float(cap))).alias("most"),
        F.element_at(F.lit([float(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).alias("w"))
    total, weight = weighed.agg(F.sum("source_size"), F.sum("w")).first()
    wanted, level = share * float(total or 0), 0.0
    if weight:
        level = wanted / weight
    while weight:  # each round stops at least one more source, so it ends
        full = F.col("most") <= F.col("w") * F.lit(level)
        stopped, weight = weighed.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("w")))).first()
        if not weight or (wanted - (stopped or 0.0)) / weight <= level:
            break
        level = (wanted - (stopped or 0.0)) / weight
    return weighed.select("source", "source_size", F.least("most", F.col("w") * F.lit(level)).alias("target"))


def _on_source(left: DataFrame, right: DataFrame, sources: int) -> DataFrame:
    right = right.withColumnRenamed("source", "__source")
    return left.join(bounded_broadcast(right, sources), left["source"].eqNullSafe(right["__source"])).drop("__source")


def mixing_plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> tuple[DataFrame, int]:
    """From (source, size, hash) rows: per source its size, target, whole
    passes, the threshold ``below`` which a document is taken once more, and
    the ``share``: how many of the rows at the threshold are, too."""
    scratch = Scratch(sized.sparkSession, "mix")
    sources, _ = scratch.write(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan, _ = scratch.write(source_targets(sources, weights, share, cap).withColumn("passes", passes.cast("bigint")))
    n = plan.count()
    open_ = plan.select("source", F.lit(0).cast("bigint").alias("prefix"),
                        (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"))
    closed = []
    for level in range(LEVELS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        bucket = F.shiftright("hash", shift)
        rows = _on_source(sized, open_, n).where(F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix"))
        sums = rows.groupBy("source", bucket.alias("bucket"), "rest").agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), F.min("hash").alias("low"),
            F.max("hash").alias("high"))
        before = F.coalesce(F.sum("size").over(
            Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        edge, _ = scratch.write(sums.withColumn("before", before)
                                .where("before <= rest and rest < before + size")
                                .withColumn("left", F.col("rest") - F.col("before")))
        one = F.col("low") == F.col("high")
        # Rows of one hash are alike in size: as many of them as come nearest to what is left.
        take = F.floor(F.col("left") * F.col("rows") / F.col("size") + 0.5)
        closed.append(edge.where(one).select(
            "source", F.when(take >= F.col("rows"), F.col("low") + 1).otherwise(F.col("low")).alias("below"),
            F.when(take < F.col("rows"), take).otherwise(F.lit(0)).alias("share")))
        open_ = edge.where(~one).select("source", F.col("bucket").alias("prefix"), F.col("left").alias("rest"))
        if open_.isEmpty():
            break
    found = closed[0]
    for more in closed[1:]:
        found = found.unionByName(more)
    found = found.select(F.col("source").alias("s"), "below", "share")
    whole = F.when(F.col("target") - F.col("passes") * F.col("source_size") > 0, F.lit(1 << HASH_BITS)).otherwise(F.lit(0))
    full, _ = scratch.write(plan.join(found, plan["source"].eqNullSafe(found["s"]), "left").select(
        "source", "source_size", "target", "passes", F.coalesce("below", whole).cast("bigint").alias("below"),
        F.coalesce("share", F.lit(0)).cast("bigint").alias("share")))
    return full, n


def _with_copies(rows: DataFrame, plan: DataFrame, sources: int, number) -> DataFrame:
    """``rows`` (source, hash and more) with the columns of their source's plan
    and ``copies``. ``number`` gives rows at a threshold their ``ordinal`` in
    the source; it is called only if a source takes some of them."""
    joined = _on_source(rows, plan, sources)
    copies = F.col("passes") + F.when(F.col("hash") < F.col("below"), F.lit(1)).otherwise(F.lit(0))
    if plan.where("share > 0").isEmpty():
        return joined.withColumn("copies", copies)
    edge = (F.col("share") > 0) & (F.col("hash") == F.col("below"))
    first = F.when(F.col("ordinal") <= F.col("share"), F.lit(1)).otherwise(F.lit(0))
    at_edge = number(joined.where(edge)).withColumn("copies", F.col("passes") + first).drop("ordinal")
    return joined.where(~edge).withColumn("copies", copies).unionByName(at_edge)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    ``copies`` (how often the mix takes it, 0 to ``cap``) and ``taken`` words.

    Null texts have no words. Rows of null source form a source of their own,
    the last. A source's words differ from its target by less than its
    largest document, rows alike in id and text included. An empty table gives
    no rows.
    """
    sized, _ = Scratch(docs.sparkSession, "mix-docs").write(docs.select(
        "doc_id", "source", word_count("text").alias("size"), mix_hash("doc_id", "text").alias("hash")))
    plan, n = mixing_plan(sized.select("source", "size", "hash"), weights, share, cap)
    number = lambda rows: group_row_number(rows, ["source"], ["hash"], "ordinal")
    return _with_copies(sized, plan, n, number).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The documents as the mix takes them: left out, once or repeated, all
    columns as they are. The plan is the one of :func:`mix`."""
    scratch = Scratch(docs.sparkSession, "mix-docs")
    sized, _ = scratch.write(docs.select(
        "source", word_count("text").alias("size"), mix_hash("doc_id", "text").alias("hash")))
    plan, n = mixing_plan(sized, weights, share, cap)
    stamped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "source",
                          mix_hash("doc_id", "text").alias("hash"))
    hashed = [f"doc.`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]

    def number(rows: DataFrame) -> DataFrame:
        """Rows are numbered by their values, then as they stand in a written table."""
        tagged, _ = scratch.write(rows.withColumn("tag", F.monotonically_increasing_id()))
        keys = tagged.select("source", F.xxhash64(*hashed).alias("values"), "tag")
        numbers = group_row_number(keys, ["source"], ["values", "tag"], "ordinal").select("tag", "ordinal")
        return tagged.join(numbers, "tag").drop("tag")

    return (_with_copies(stamped, plan, n, number).where("copies > 0")
            .select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("doc.*"))
