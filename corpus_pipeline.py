"""Corpus preparation: five stages over ``documents``, each calling one operator.

Every stage takes all its predecessor kept, written as Parquet and read
again.  The first four return the columns of ``documents``; the last
returns the sampled token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import mixing, pieces, quality, secrets, simhash
from tessera.llm.common import materialise
from tessera.llm.queries import good_ids


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the target is the labelled good ones."""
    return quality.filter_documents(docs, good_ids(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within 2 bits (SimHash over three-word shingles)."""
    return simhash.keep_representatives(docs, shingle=3, max_bits=2)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets replaced by a mask."""
    return secrets.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every document, as piece ids."""
    return pieces.sample(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_sources),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# The likelihood ratio, the fingerprints, the flow and the sampler are not SQL;
# tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage{i}")
    return docs
