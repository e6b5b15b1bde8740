"""Incremental bronze loads with Structured Streaming.

The batch loader takes the newest file per dataset. This mode instead takes
every raw file once: a ``binaryFile`` stream over the raw zone tracks which
files were seen in its checkpoint (under ``spark.checkpoint.dir``), and each
micro-batch loads its new files into bronze with the batch loader.

A batch may be run again after a failure, and each file's rows still arrive once:

* all files of the batch are parsed to staged files first, so a malformed one
  stops the batch before bronze is touched;
* the rows of a dataset's new files are one bronze load, named by a hash of their
  paths, so running the batch again replaces the same partition; after it, the
  paths go to the load log (path, dataset, batch), which is what keeps files out
  that another stream or checkpoint brings up again.

Only paths reach the driver, at most ``max_files`` per batch.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelhouse.functions.paths import infer_dataset
from reelhouse.plans import catalog
from reelhouse.session import checkpoint_dir
from reelhouse.sources import bronze

LOAD_LOG = "bronze_load_log"

# The binaryFile source's own schema.
BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


LOG_SCHEMA = "path string, dataset string, batch_id long"


def _write_log(spark: SparkSession, layer: str, rows: list[tuple]) -> None:
    catalog.append_table(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), layer, LOAD_LOG)


def load_batch(spark: SparkSession, files: DataFrame, batch_id: int, layer: str = "bronze",
               silver_layer: str | None = None, on_bad: str = "fail", **opts) -> int:
    """Load the export files of one micro-batch; returns the number of files loaded.

    With ``silver_layer`` the loads are also folded into that layer's
    silver tables (``plans.run.refresh_silver``, with ``on_bad``), keeping
    silver current file by file.
    """
    from reelhouse.plans.run import refresh_silver

    tagged = files.select("path", infer_dataset("path").alias("dataset")).where(F.col("dataset").isNotNull())
    if catalog.table_exists(spark, layer, LOAD_LOG):
        tagged = tagged.join(spark.table(f"{layer}.{LOAD_LOG}").select("path"), "path", "left_anti")
    groups: dict[str, list[str]] = {}
    for r in tagged.collect():
        groups.setdefault(r["dataset"], []).append(r["path"])
    # parse everything before the first append
    parsed = {
        ds: catalog.staged(bronze.read_files(spark, sorted(paths), ds, **opts), f"stream-{ds}")
        for ds, paths in sorted(groups.items())
    }
    for ds, rows in parsed.items():
        paths = sorted(groups[ds])
        load_id = hashlib.sha256("\n".join([ds, *paths]).encode()).hexdigest()
        bronze.append_bronze(rows, ds, layer, load_id)
        if silver_layer is not None and catalog.table_exists(spark, layer, ds):
            refresh_silver(spark, ds, on_bad, layer, silver_layer)
        _write_log(spark, layer, [(p, ds, batch_id) for p in paths])
    return sum(len(paths) for paths in groups.values())


def stream_bronze(
    spark: SparkSession,
    raw_prefix: str,
    layer: str = "bronze",
    checkpoint: str | None = None,
    max_files: int = 1000,
    glob: str = "*.csv",
    silver_layer: str | None = None,
    on_bad: str = "fail",
    **opts,
) -> StreamingQuery:
    """Start an ``availableNow`` stream that loads every new export file under
    ``raw_prefix`` into bronze (and, with ``silver_layer``, folds it into
    silver) and then stops."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    location = checkpoint or os.path.join(checkpoint_dir(spark), "bronze_stream")
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", str(max_files))
        .load(raw_prefix)
    )
    return (
        files.writeStream.foreachBatch(
            lambda df, batch_id: load_batch(spark, df, batch_id, layer, silver_layer, on_bad, **opts)
        )
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
