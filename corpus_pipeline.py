"""The corpus pipeline: documents in, sharded training rows out.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept. ``run`` writes each result as Parquet to the shared checkpoint folder and
reads it back as the input of the next, so a lost executor costs at most the
stage that runs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelhouse.llm import decontaminate, language_id, minhash_dedup, mixing, sharding
from reelhouse.llm.common import stage, table


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents without a language that can be told go."""
    return language_id.identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of near copies (five words, 0.8) stays."""
    return minhash_dedup.near_dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold benchmark items go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: shard and slot of every row."""
    return sharding.histogram_shard(docs)


STAGES = [
    ("language", keep_identified),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("mix", mix_sources),
    ("shard", shard),
]

#: Language models and hashes are not SQL: tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
