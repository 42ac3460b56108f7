"""A corpus from raw documents: language identification, near-duplicate removal, decontamination, packing.

``STAGES`` lists (name, function) in order. Each function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, langid, near_dup, packing
from plumbline.llm.stored import Stored, small_batches

#: Near-duplicate stage: runs of five words, similarity of 0.8 or more.
WORDS, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letters, or unlike all texts of every learned language."""
    small_batches(spark)
    return langid.keep_identified(docs, langid.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, that of the smallest id."""
    small_batches(spark)
    return near_dup.drop_duplicates(docs, width=WORDS, percent=PERCENT)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of whose words at least a twentieth lies in passages of the benchmark."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, each from one document, with their token ids and a checksum."""
    small_batches(spark)
    return packing.pieces(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate_documents),
    ("packing", pack),
]

#: Character models and token ids cannot be had in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stored = Stored(spark)
    for _, stage in STAGES:
        docs = stored.table(stage(spark, docs, sf_dir), keep=True)
    return docs
