"""From raw documents to packed training sequences: each stage reads what the stage before it kept.

Quality rules drop documents that fail; near-dedup keeps one document of each group; decontamination drops documents
that hold a benchmark passage; the secret scan masks secrets in the texts that have any; packing cuts and packs all
that is left. An empty table stays empty in every stage, nulls in any column and columns of any further name pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from almanac.llm import decontaminate, packing, quality, secrets, simhash
from almanac.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules; those with a null or empty text fail. Repeated rows are judged each."""
    return quality.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies; null and empty texts are one group, repeated rows belong together."""
    return simhash.keep_first(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage; null and empty texts hold none, empty items are in no text."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets masked and n_chars of those texts counted anew; null and empty texts stay as they are."""
    return secrets.redact(docs, secrets.new_ledger(spark))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows; a null or empty text is one piece of the end mark alone, rows with one id are cut each."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL has no word fingerprints or tokenizers; the tests compare with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each stored and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
