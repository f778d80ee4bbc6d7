"""The registered queries of this package: name -> (build(spark, sf_dir), DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tableload.llm import (
    embedding_whitening,
    fingerprints,
    language_id,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    token_files,
    url_filter,
)


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


REGISTRY: dict[str, Query] = {
    "op1_token_counts": Query(
        lambda s, d: token_counts.token_counts(_table(s, d, "documents"), tokenizer_path("piece_bpe_32k.model"))),
    "op2_ngram_join": Query(lambda s, d: ngram_join.ngram_join(_table(s, d, "documents"))),
    "op3_quality_classifier": Query(
        lambda s, d: quality_classifier.quality_classifier(_table(s, d, "documents"), _table(s, d, "labels"))),
    "op4_substring_dedup": Query(lambda s, d: substring_dedup.substring_dedup(_table(s, d, "documents"))),
    "op5_fingerprints": Query(lambda s, d: fingerprints.fingerprint_edits(_table(s, d, "documents"))),
    "op6_quality_rules": Query(lambda s, d: quality_rules.quality_rules(_table(s, d, "documents")), quality_rules.SQL),
    "op7_language_id": Query(lambda s, d: language_id.language_id(_table(s, d, "documents"))),
    "op8_mixing": Query(lambda s, d: mixing.mix(_table(s, d, "documents")), mixing.SQL),
    "op9_packing": Query(lambda s, d: packing.pack(_table(s, d, "documents"), tokenizer_path("byte_bpe_50k.json"))),
    "op10_token_files": Query(
        lambda s, d: token_files.token_files(_table(s, d, "documents"), tokenizer_path("word_bpe_49k.json"))),
    "op11_embedding_whitening": Query(lambda s, d: embedding_whitening.whiten(_table(s, d, "embeddings"))),
    "op12_periodic_runs": Query(lambda s, d: periodic_runs.run_digests(_table(s, d, "documents"))),
    "op13_url_filter": Query(lambda s, d: url_filter.url_filter(_table(s, d, "pages")), url_filter.SQL),
}
