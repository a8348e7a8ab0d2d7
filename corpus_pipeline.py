"""From raw documents to token ids: the stages of the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from edgelog.llm import byte_bpe, decontaminate, exact_dedup, minhash, shared, toxicity
from edgelog.llm.queries import VOCABULARY


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: similarity 0.8 of five-word shingles.

    Candidates by the fingerprints and pigeonhole of op9, and by MinHash keys for pairs that lie further apart.
    """
    return minhash.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its bytes again."""
    path = public_tokenizers.path(VOCABULARY)
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", benchmark),
    ("tokens", tokens),
]

#: The stages train a model, compare hashes and merge byte pairs: no SQL states them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    shared.ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), name)
    return docs
