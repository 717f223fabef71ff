"""A training-data pipeline over `documents`: each stage reads what the one before has kept.

Language identification drops what it rejects; of each group of near copies one document stays;
byte strings that occur again are cut out; documents are sampled to target weights; what is left
is encoded as tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinia.llm import language, mixing, pieces, simhash, suffixes
from affinia.session import store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not reject; it is trained on its input."""
    return language.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies, which SimHash
    fingerprints of three-word shingles at two differing bits or fewer connect."""
    return simhash.keep_one_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that occur again; emptied documents go."""
    return suffixes.strip_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with tempered source, language and topic marginals."""
    return mixing.sample(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, ids and n_tokens of each document."""
    return pieces.encode(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

# Trained models, 64-bit hashes and tokenizers are beyond SQL; tests/llm/test_pipeline.py checks
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
