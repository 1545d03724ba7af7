"""A pipeline from raw documents to packed training sequences: STAGES, one after another.

Each stage is an operator of ``lexloom.llm`` applied to all that its predecessor kept; its result is
written as Parquet to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import bpe, exact_dedup, mixing, near_copies, packing, shared, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to the case of A-Z, the smallest id stays."""
    return exact_dedup.drop_copies(docs, keep="min")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share most of their five-word shingles, the smallest id stays."""
    return near_copies.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut or repeated to their target weights."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces take their places in sequences of 2,048."""
    return packing.pack(docs, bpe.public_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The toxicity, near-copy and packing stages cannot be put in SQL.  Tests hold near copies and packed pieces against
#: brute force, the label model against plain EM, and what toxicity rejects against held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
