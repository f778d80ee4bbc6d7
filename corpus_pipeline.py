"""From raw documents to packed training sequences, one operator per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's result to the shared folder and hands the re-read table to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableload.llm import mixing, ngram_join, packing, quality_rules, substring_dedup
from tableload.llm.queries import Query, tokenizer_path
from tableload.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail go."""
    return quality_rules.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays; five-word grams, similarity 0.8."""
    return ngram_join.keep_one(docs, k=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: words of repeated windows go."""
    return substring_dedup.remove_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each source's documents are repeated or cut to its budget."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substrings),
    ("mixing", mixture),
    ("packing", packed),
]

# Packing and the hash-based stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{n}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


PIPELINE = {"pipeline": Query(run, ORACLE_SQL)}
