"""From raw documents to token ids, in five stages. Each stage works on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rateloom.llm import mixing, near_duplicates, pieces, quality, toxicity
from rateloom.llm.shared import fresh_path, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5 stay."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.7 or more stay."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, that with the smallest id; documents without words all stay."""
    return near_duplicates.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.copied(docs)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, lossless, ids."""
    return pieces.sample_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicate_join),
    ("mixing sources", source_mix),
    ("SentencePiece", sentencepiece_ids),
]

#: The first two stages learn and the last one draws: no SQL. Tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
