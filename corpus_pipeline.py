"""From raw documents to token digests: language ID, exact dedup, near-dedup, decontamination, BPE.

Each stage reads what its predecessor kept, and is written as Parquet to the shared folder before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import bpe_tree, decontaminate, exact_dedup, language, near_dedup
from roadpulse.llm.common import shared_folder

#: Documents whose language is surer than a guess among four stay; junk and mixed documents do.
LEAST_LANGUAGE_SCORE = 0.25
#: Near copies: word shingles of five, similarity in percent.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no sure language, go."""
    return language.keep_identified(docs, LEAST_LANGUAGE_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies stays."""
    return near_dedup.keep_one(docs, NEAR_SHINGLE, NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return bpe_tree.encode_digests(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("BPE encoding", encode),
]

#: Language ID and BPE are not expressible in SQL; the tests run a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
