"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest. A load is first reduced to
one row per digest (partial aggregation, so a text that fills a third of the
load sends one row per map task), then sort-merge anti-joined with the index:
the index side is not shuffled, being bucketed already. What is left is new and
is appended. Loads arrive in order of precedence: the first holder of a digest
stays; inside a load the largest id stays.

Defined results: a null text counts as empty; a null id is smaller than any
other and never replaces one; rows that repeat both id and text are one
document and are kept or dropped together; an empty table gives an empty
result; only the id and text columns are read, so extra columns may have any
name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import ascii_lower, stage, table

#: Buckets of the index. A bucket is one task of the anti-join; raise it with the
#: corpus (32 bytes of digest a text: 2,048 buckets hold 10 billion texts at 200 MB each).
BUCKETS = 32


def with_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the text with A-Z lower-cased."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    )


class DigestIndex:
    """digest -> keep_id, one row per distinct text ever added."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS):
        self.spark, self.name, self.buckets = spark, name, buckets
        if not spark.catalog.tableExists(name):
            empty = spark.createDataFrame([], "digest binary, keep_id bigint")
            self._writer(empty, "ignore").saveAsTable(name)

    def _writer(self, df: DataFrame, mode: str):
        return df.write.mode(mode).format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")

    def frame(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, load: DataFrame) -> None:
        """Append what ``load`` (doc_id, digest) has and the index has not.

        Running a load again after a failure adds nothing twice.
        """
        per_text = load.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        new = per_text.join(self.frame().hint("merge"), "digest", "left_anti")
        self._writer(new.select("digest", "keep_id"), "append").saveAsTable(self.name)


def classes(index: DigestIndex, loads: list[DataFrame], members: DataFrame) -> DataFrame:
    """One row per member: doc_id, keep_id, group_size, kept, text_sha256.

    ``members`` (doc_id, digest) is a staged table; ``loads`` are its parts in
    order of precedence. The last join has a plain scan on both sides, so AQE
    splits the partition of a text that fills much of the corpus.
    """
    for load in loads:
        index.add(load)
    sizes = members.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = stage(sizes.join(index.frame(), "digest"), "exact-groups")
    return members.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                index_name: str | None = None, loads: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """Class of every document; the row with the largest id of equal texts stays.

    The corpus is fed to the index as ``loads`` loads of falling id ranges.
    Without ``index_name`` the index is a new table of its own.
    """
    spark = docs.sparkSession
    members = stage(with_digest(docs, id_col, text_col), "exact-members")
    low, high = members.agg(F.min("doc_id"), F.max("doc_id")).first()
    parts = []
    if low is not None:
        edges = [low + (high - low + 1) * i // loads for i in range(loads + 1)]
        parts = [members.where((F.col("doc_id") >= a) & (F.col("doc_id") < b))
                 for a, b in zip(edges, edges[1:])][::-1]
    parts.append(members.where(F.col("doc_id").isNull()))
    index = DigestIndex(spark, index_name or f"digest_index_{uuid.uuid4().hex}", buckets)
    return classes(index, parts, members)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""
