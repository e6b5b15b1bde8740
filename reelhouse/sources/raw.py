"""Raw zone: list landed files, pick the latest per dataset, admit, fingerprint,
land unchanged and keep an ingestion ledger.

Listings are made by executors, folder by folder, and never read file bytes;
hashes and copies read them in blocks (``sources.files``). Everything returned is
a lazy DataFrame except the few helpers that name a single object key or the
dataset set (at most six values) for the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse import specs
from reelhouse.functions.paths import file_name, has_suffix, infer_dataset
from reelhouse.operators.dedupe import keep_first
from reelhouse.operators.order import top_k
from reelhouse.sources import files

def list_raw(spark: SparkSession, prefix: str) -> DataFrame:
    """Every file under ``prefix`` (all levels): path, modificationTime, length.
    Empty files and names that start with ``_`` or ``.`` are files like others."""
    return files.listing(spark, prefix, True)


def list_drop(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """R2: files directly in ``folder`` whose name matches ``glob``, sorted by
    path; a missing folder gives an empty listing."""
    return files.listing(spark, folder, False, glob).orderBy(F.col("path").asc_nulls_last())


def with_dataset(listing: DataFrame, path_col: str = "path", strict: bool = False) -> DataFrame:
    """R3 as a column: ``dataset`` from the file name (NULL when none)."""
    return listing.withColumn("dataset", infer_dataset(path_col, strict))


LATEST_ORDER = ["modificationTime desc nulls last", "path asc"]


def latest_objects(listing: DataFrame) -> DataFrame:
    """R4 for all datasets at once: per dataset the newest file; on equal times
    the smaller path (the one an object store lists first) wins."""
    tagged = listing if "dataset" in listing.columns else with_dataset(listing)
    named = tagged.where(F.col("dataset").isNotNull())
    return keep_first(named, ["dataset"], LATEST_ORDER, total=False)


def latest_object(listing: DataFrame, dataset: str) -> DataFrame:
    """R4 for one dataset: zero or one row."""
    specs.spec(dataset)  # unknown names raise
    ds = dataset.lower()
    tagged = listing if "dataset" in listing.columns else with_dataset(listing)
    return top_k(tagged.where(F.col("dataset") == ds), LATEST_ORDER, 1, total=False)


def latest_by_suffix(listing: DataFrame, suffix: str) -> DataFrame:
    """Newest file whose path ends with ``suffix`` (any case)."""
    return top_k(listing.where(has_suffix("path", suffix)), LATEST_ORDER, 1, total=False)


def latest_key(latest: DataFrame, what: str) -> str:
    """Path of a zero-or-one-row result of R4/R5; none found raises."""
    row = latest.select("path").first()
    if row is None:
        raise FileNotFoundError(f"No object found for {what}")
    return row["path"]


def available_datasets(listing: DataFrame) -> DataFrame:
    """The datasets that have at least one file, sorted."""
    tagged = listing if "dataset" in listing.columns else with_dataset(listing)
    return (
        tagged.select("dataset")
        .where(F.col("dataset").isNotNull())
        .distinct()
        .orderBy(F.col("dataset").asc_nulls_last())
    )


def available_dataset_names(listing: DataFrame) -> list[str]:
    """R6 for the caller: at most six names; none raises."""
    names = [r["dataset"] for r in available_datasets(listing).collect()]
    if not names:
        raise FileNotFoundError("No export files for any supported dataset were found")
    return names


# The two reasons a file is turned away on upload.
REJECT_NOT_CSV = "Only .csv files are supported"
REJECT_EMPTY = "Empty file"


def admit(listed: DataFrame, name_col: str = "name", size_col: str = "length") -> DataFrame:
    """``admitted`` and ``reason`` per file: the name must end in .csv (any
    case) and the file must not be empty."""
    is_csv = F.lower(F.col(name_col)).endswith(".csv")
    reason = F.when(~is_csv, F.lit(REJECT_NOT_CSV)).when(
        F.col(size_col) <= 0, F.lit(REJECT_EMPTY)
    )
    return listed.withColumn("reason", reason).withColumn(
        "admitted", F.col("reason").isNull()
    )


def fingerprint(contents: DataFrame, content_col: str = "content") -> DataFrame:
    """Byte length and SHA-256 hex of bytes in a column (``files.hashed`` reads files)."""
    content = F.col(content_col)
    return contents.withColumn("size_bytes", F.octet_length(content).cast("long")).withColumn(
        "sha256", F.sha2(content, 256)
    )


def utc_text(ts: Column, ts_type: T.DataType, fmt: str) -> Column:
    """Format a timestamp as UTC wall-clock text whatever the session zone is."""
    if isinstance(ts_type, T.TimestampType):
        ts = F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(ts, fmt)


def with_object_key(
    hashed: DataFrame,
    ts_col: str,
    sha_col: str = "sha256",
    name_col: str = "name",
    prefix: str = specs.RAW_PREFIX,
) -> DataFrame:
    """``<prefix>yyyy/MM/dd/HHmmss_<sha[:12]>_<name, spaces as _>`` (UTC)."""
    ts_type = hashed.schema[ts_col].dataType
    key = F.concat(
        F.lit(prefix),
        utc_text(F.col(ts_col), ts_type, "yyyy/MM/dd/HHmmss"),
        F.lit("_"),
        F.substring(F.col(sha_col), 1, 12),
        F.lit("_"),
        F.replace(F.col(name_col), F.lit(" "), F.lit("_")),
    )
    return hashed.withColumn("object_key", key)


def land(keyed: DataFrame, raw_dir: str, path_col: str = "path", key_col: str = "object_key",
         sha_col: str = "sha256") -> None:
    """Copy each file unchanged to ``raw_dir/<object key>``.

    Executors copy in blocks from path to path (``files.copied``), so a file has
    any size and no content is in a row. ``raw_dir`` is a path or URI as Spark
    takes it; a scheme that Arrow does not know raises before a byte is written.
    """
    files.copied(keyed, raw_dir, path_col, key_col, sha_col)


def uuid_from(*cols: Column) -> Column:
    """Deterministic UUID-shaped id from the SHA-256 of the given columns.

    Unlike ``uuid()`` it is the same on every task retry, so a re-run or a lost
    executor cannot give one file two ledger ids.
    """
    h = F.sha2(F.concat_ws("/", *cols), 256)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )


def ledger_rows(
    landed: DataFrame,
    bucket: str = specs.DEFAULT_BUCKET,
    name_col: str = "name",
    size_col: str = "size_bytes",
    content_type_col: str | None = None,
    created_col: str | None = None,
) -> DataFrame:
    """One ledger row per landed file (status ``uploaded``)."""
    created = F.col(created_col) if created_col else F.current_timestamp()
    ctype = F.col(content_type_col) if content_type_col else F.lit(None).cast("string")
    return landed.select(
        uuid_from(F.lit(bucket), F.col("object_key")).alias("ingestion_id"),
        F.lit(specs.LEDGER_SOURCE).alias("source"),
        F.col(name_col).alias("original_filename"),
        F.lit(bucket).alias("bucket"),
        F.col("object_key"),
        F.col(size_col).cast("long").alias("size_bytes"),
        ctype.alias("content_type"),
        F.lit(specs.UPLOADED).alias("status"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def insert_if_absent(
    target: DataFrame,
    rows: DataFrame,
    key: Sequence[str] = ("ingestion_id",),
    order: Sequence[str] = ("created_at asc",),
) -> DataFrame:
    """The rows to append so that ``key`` stays unique.

    In-batch duplicates keep the first row in ``order`` (then all columns), and
    keys already in ``target`` are dropped by an anti join; the join strategy
    (broadcast only when the target's measured size is small) is left to AQE.
    """
    fresh = keep_first(rows, list(key), list(order))
    return fresh.join(target.select(*key), list(key), "left_anti")


def recent_runs(ledger: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` ledger rows by created_at."""
    return top_k(ledger, ["created_at desc"], n)


def files_named(listing: DataFrame) -> DataFrame:
    """Listing plus the bare file ``name``."""
    return listing.withColumn("name", file_name("path"))
