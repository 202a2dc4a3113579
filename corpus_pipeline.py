"""Training-data pipeline over the documents table.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a DataFrame, which is written as Parquet and read again as
the next stage's documents. All stages but the last return the columns of
documents, rows as they came; an empty table passes through. What each stage
does with null ids, null texts and repeated rows is stated at its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import decontaminate, mixing, simhash, token_files, toxicity
from claimsmith.llm.common import materialize, read_table
from claimsmith.llm.queries import tokenizer_path


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier marks go; it learns from the labels of
    ids that are not held out."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model, out="__toxicity")
    return scored.where(F.col("__toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one_of_each(docs, shingle=3, max_bits=2)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go."""
    marked = decontaminate.mark_contamination(docs, read_table(spark, sf_dir, "benchmark"), out="__contamination")
    return marked.where(~decontaminate.is_contaminated("__contamination")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their source take them."""
    return mixing.mixed_documents(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the documents; returns their index, read from the files."""
    return token_files.encode_and_index(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", remove_contaminated),
    ("source_mixing", mix_sources),
    ("token_id_output", write_token_ids),
]

#: Models, hashes and encodings of the stages have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
