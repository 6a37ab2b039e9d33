"""The training-data pipeline: stages over ``documents``, each written and read again.

Each stage takes all rows its predecessor kept and returns the columns of ``documents``; the last
returns a row per document of the token files.  A row without doc_id passes through all stages; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyflow.llm import decontaminate, mixing, near_dedup, quality_rules, token_files
from tallyflow.llm.queries import WORD_BPE, WORD_BPE_END, table, tokenizer
from tallyflow.session import work_dir


def pass_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the production policy of the quality rules."""
    return quality_rules.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to count as contaminated."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what is read back from them."""
    manifest = token_files.write_token_files(docs, work_dir(spark, "token-files"), tokenizer(WORD_BPE),
                                             WORD_BPE_END)
    return token_files.read_token_files(manifest)


STAGES = [
    ("quality rules", pass_quality),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]
# Near-duplicate classes and token ids cannot be expressed in SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again."""
    folder = work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
