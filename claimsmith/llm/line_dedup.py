"""Line de-duplication with DataFrame functions only.

1. Every line becomes a row: a 128-bit hash of its key, its document and its
   position. Rows are range-partitioned by (hash, document) and sorted by
   (hash, document, position), so a line that a third of all documents hold
   spans many partitions; the first occurrence of a line in a document is
   marked as the sorted rows stream by, without another shuffle. A document is
   an id here: a line in two rows of one id counts once.
2. First occurrences are counted per hash (a partial sum per task first).
3. Hashes of enough documents are joined back to the rows; adaptive execution
   splits the join's hot hashes.
4. A document's rows become its keep bitmap, as runs of kept lines. The text
   itself is neither sorted nor returned.

Rows of one id with different texts are one document when lines are counted,
and each text keeps a bitmap of its own; repeated rows are one. A row without
an id is a document by its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.llm.common import WHITE, Scratch, ascii_lower

MIN_DOCUMENTS = 10


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _line_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """(a, b, doc_id, t, pos, keyed, first) in hash order; ``first`` marks the
    line's first occurrence in its document. A line without a
    key gets a hash of its place, so such lines do not meet."""
    lines = docs.select("doc_id", F.xxhash64(text_col).alias("t"), F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"))
    keys = lines.select("doc_id", "t", "pos", line_key(F.col("line")).alias("key"))
    keyed = F.char_length("key") >= 1
    place = F.struct("doc_id", "t", "pos")
    rows = keys.select(
        F.when(keyed, F.xxhash64("key")).otherwise(F.xxhash64(place)).alias("a"),
        F.when(keyed, F.xxhash64(F.lit(1), "key")).otherwise(F.xxhash64(F.lit(2), place)).alias("b"),
        "doc_id", "t", "pos", keyed.alias("keyed"))
    by = ["a", "b", "doc_id", "unnamed"]
    named = rows.withColumn("unnamed", F.when(F.col("doc_id").isNull(), F.col("t")))
    ranged = named.repartitionByRange(*by).sortWithinPartitions(*by, "t", "pos")
    seen = F.row_number().over(Window.partitionBy(*by).orderBy("t", "pos"))
    return ranged.withColumn("first", F.col("keyed") & (seen == 1)).drop("unnamed")


def keep_runs(n_lines: Column, dropped: Column) -> Column:
    """Runs (first line from 1, number of lines) that stay, from the
    ascending positions (from 0) of the dropped ones."""
    before, after = F.concat(F.array(F.lit(-1)), dropped), F.concat(dropped, F.array(n_lines.cast("int")))
    gaps = F.zip_with(before, after, lambda p, q: F.struct((p + 2).alias("first"), (q - p - 1).alias("lines")))
    return F.filter(gaps, lambda g: g["lines"] > 0)


def keep_bitmaps(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, text_col: str = "text") -> DataFrame:
    """(doc_id, t, n_lines, n_dropped, keep) for every distinct (doc_id,
    text); ``t`` is the text's xxhash64, ``keep`` the compressed bitmap: runs
    of lines that stay.

    A line's key is the line without white space at both ends, A-Z lowered;
    lines without a key stay. A line counts once for an id, whatever number of
    texts it has; texts of null ids are documents of their own; null and
    empty texts have one line, which stays. An empty table gives no rows.
    Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    rows, _ = scratch.write(_line_rows(docs, text_col))
    # Written, so that the join reads both sides from shuffles it can split at hot lines.
    frequent, _ = scratch.write(rows.where("first").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
                                .where(F.col("n") >= min_documents).select("a", "b", F.lit(True).alias("frequent")))
    by_doc = rows.join(frequent, ["a", "b"], "left").groupBy("doc_id", "t").agg(
        (F.max("pos") + 1).cast("bigint").alias("n_lines"),
        F.sort_array(F.collect_set(F.when(F.col("frequent"), F.col("pos")))).alias("dropped"))
    return by_doc.select("doc_id", "t", "n_lines", F.size("dropped").cast("bigint").alias("n_dropped"),
                         keep_runs(F.col("n_lines"), F.col("dropped")).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of the keep bitmap's runs, joined again."""
    lines = lines_of(text)
    return F.array_join(F.transform(keep, lambda k: F.array_join(F.slice(lines, k["first"], k["lines"]), "\n")), "\n")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with their bitmap's n_lines, n_dropped and keep."""
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", "keep")]
    packed = docs.select(F.struct(*own).alias("doc"), F.col("doc_id").alias("of_id"), F.xxhash64(text_col).alias("of_text"))
    same = packed["of_id"].eqNullSafe(bitmaps["doc_id"]) & (packed["of_text"] == bitmaps["t"])
    return packed.join(bitmaps, same).select("doc.*", "n_lines", "n_dropped", "keep")
