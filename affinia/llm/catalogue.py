"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from affinia.llm import (
    byte_bpe, language, lexical, licenses, merkle, mixing, neighbours, phrases, pieces, quality, sharding, simhash, suffixes,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_documents(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_digest(_table(spark, sf_dir, "documents"))


def op9_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprints_with_edits(_table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_digest(_table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited_documents(_table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digest(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_mixing, op2_simhash, op3_neighbours, op4_sharding, op5_quality,
        op6_language, op7_licenses, op8_suffixes, op9_phrases, op10_pieces,
        op11_lexical, op12_merkle, op13_byte_bpe,
    )
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return {"op1_mixing": mixing.oracle(), "op11_lexical": lexical.oracle(), "op12_merkle": merkle.oracle()}
