"""Helpers shared by the operators: reading, staging, plain text functions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A word: a run without space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage (a lost executor costs no recomputation) and gives later joins
    plain scans on both sides, whose skewed partitions AQE can split.
    """
    path = stage_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(_nullable(df)).parquet(path) if not partition_by else df.sparkSession.read.parquet(path)


def _nullable(df: DataFrame):
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z and nothing else. Null stays null.

    For a text of ASCII alone ``lower`` is the same and much faster.
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower())
    )


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A driver-made frame of bounded size (the callers state the bound)."""
    return spark.createDataFrame(rows, schema)


def byte_sizes(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text, null 0, as int64."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def portions(batch: pa.RecordBatch, column: int, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` text bytes each, one row at least."""
    ends = np.cumsum(byte_sizes(batch.column(column)))
    start, begun = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, begun + most, side="right")))
        yield batch.slice(start, stop - start)
        start, begun = stop, int(ends[stop - 1])


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased. ``bytes.lower`` and ``bytes.split``
    know ASCII only, which is the definition of case and white space here."""
    return text.lower().split() if text else []


def flat(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[Column], list[str]]:
    """``docs`` with columns c0, c1, .., so that an operator's own names clash with
    none of them; the columns that bring their names back; the new names of ``columns``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    lower = [c.lower() for c in docs.columns]
    found = [names[docs.columns.index(c) if c in docs.columns else lower.index(c.lower())] for c in columns]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)], found


def row_keys(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rows`` (of ``flat``) with __key (id, null as the least long) and __mark (hash of the text)."""
    return rows.withColumns({"__key": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), "__mark": F.xxhash64(text_col)})


def only_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose (doc_id, mark) is in ``kept``, each once."""
    rows, back, (id_, text) = flat(docs, id_col, text_col)
    keys = stage(kept.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("__key"), F.col("mark").alias("__mark")).distinct(), "kept-rows")
    keyed = row_keys(rows, id_, text).join(keys, ["__key", "__mark"], "left_semi")
    return keyed.dropDuplicates(["__key", "__mark"]).select(*back)
