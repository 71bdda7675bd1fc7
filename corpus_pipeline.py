"""A corpus pipeline of five training-data operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.bpe import bpe_tokens
from ledgerloom.llm.common import checkpoint
from ledgerloom.llm.mixing import mix_documents
from ledgerloom.llm.quality import fit_quality, keep_good
from ledgerloom.llm.queries import vocabulary_path
from ledgerloom.llm.simhash import drop_near_duplicates
from ledgerloom.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are toxic with a probability of 0.5 or more."""
    return drop_toxic(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that fail the base rules or the classifier."""
    return keep_good(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five-word shingles, similarity 0.8)."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops whole documents so that sources near their target weights."""
    return mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of every document of the mix."""
    return bpe_tokens(docs, vocabulary_path())


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicates", near_duplicates), ("mix", mix), ("tokenize", tokenize)]

#: The trained stages have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are checkpointed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpoint(docs)
    return docs
