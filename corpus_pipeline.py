"""Corpus pipeline: language ID, near-duplicates, decontamination, mixing, sharding.

Every stage takes all documents its predecessor kept and returns the columns of
``documents``; the last one adds the shard and slot of each row.  ``run`` writes
each stage to the shared checkpoint folder and reads it back for the next, so a
lost executor never costs more than the stage it worked on, and removes what no
later stage reads.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from metricspark.llm.decontam import decontaminate
from metricspark.llm.langid import reject_unidentified
from metricspark.llm.mixing import mixed_documents
from metricspark.llm.near_dup import deduplicate
from metricspark.llm.sharding import shard_by_bytes
from metricspark.llm.staging import drop_folder, stage_alone

MIX_BLOCK_WORDS = 256
SHARDS = 24


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the fused evidence identifies."""
    return reject_unidentified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.75 or more)."""
    return deduplicate(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it stands or with other values."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The source mixture as whole documents, each as often as the block it starts in is drawn."""
    return mixed_documents(docs, block_words=MIX_BLOCK_WORDS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-balanced shards and slots; equal texts share a shard."""
    return shard_by_bytes(docs, SHARDS, carry=True).select("document.*", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES[:-1]:
        docs, folder = stage_alone(spark, name, partial(step, spark, docs, sf_dir))
        if before:
            drop_folder(spark, before)  # no later stage reads it
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
