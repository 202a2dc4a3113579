"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame.

Each one applies its operator, with production parameters, to its whole table
and derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import (class_lm, decontaminate, divergence, licenses, line_dedup, mixing, paragraphs, rabitq, resample, simhash,
                            token_counts, token_files, toxicity)
from claimsmith.llm.common import LOWER, UPPER, read_table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_rabitq_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.nearest(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, max_bits=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model, out="score").select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", F.col("contamination.n_words").alias("n_words"), F.col("contamination.n_hit").alias("n_hit"),
        F.size("contamination.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_documents=10))
    kept = line_dedup.kept_text(F.col("text"), F.col("keep"))
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f USING (key)
GROUP BY doc_id
"""


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.encode_and_index(docs, tokenizer_path())


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: a document lies in source/lang/hundred, and a
    document of under 50 words with a licence line speaks for its directory."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan_licences(docs, path, F.col("__words") < 50, keep=("doc_id",))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer_path()).select("doc_id", "token_count.*")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read_table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP12_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
tokens AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
sources AS (SELECT DISTINCT lang, source FROM docs),
groups AS (
  SELECT s.lang, s.source, coalesce(l.v, 0) AS v, coalesce(t.n, 0) + 2 * coalesce(l.v, 0) AS mass, l.n + 2 * l.v AS lang_mass
  FROM sources s LEFT JOIN totals t ON s.lang = t.lang AND s.source = t.source LEFT JOIN langs l ON s.lang = l.lang),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // g.mass AS p,
         1 + (1000000000::HUGEINT * (k.total + 2)) // g.lang_mass AS q
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT a.lang, a.source, b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_rabitq_neighbours": op1_rabitq_neighbours,
    "op2_source_mixing": op2_source_mixing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_paragraph_dedup": op5_paragraph_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op8_class_lm": op8_class_lm,
    "op9_token_id_files": op9_token_id_files,
    "op10_license_scan": op10_license_scan,
    "op11_token_counts": op11_token_counts,
    "op12_source_divergence": op12_source_divergence,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE: dict[str, str] = {"op7_line_dedup": OP7_SQL, "op12_source_divergence": OP12_SQL}
