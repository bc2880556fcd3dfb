"""The stages that make packed training sequences of a document table.

Each stage calls one operator on all rows its predecessor kept; its result is written as Parquet
and read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from obligo.llm import exact_dedup, mixing, packing, simhash, toxicity
from obligo.llm.common import documents
from obligo.session import remove_folder, scratch_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    return toxicity.clean_rows(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the largest id stays."""
    return exact_dedup.ExactDedup(spark, docs).kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.kept_rows(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken to the target weights of their sources; a repeated one is there twice."""
    return mixing.mixed_rows(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset.

    Workers hold what earlier stages left them, so they remember fewer words than they might.
    """
    return packing.packed(spark, docs, remembered=REMEMBERED)


REMEMBERED = 100_000

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# Tokenising, trees and fingerprints have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents. A stage's table goes when the next one is written."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = f"{scratch_folder(spark)}/{name}-{uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
