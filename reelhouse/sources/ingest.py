"""Upload flow (R7-R12 composed): admit, fingerprint, key, land, ledger.

Files in a drop folder are checked, hashed and copied unchanged into the raw
zone under a content-addressed key, and one ledger row per file is appended
when its id is not there yet. The upload time is taken once on the driver, so
the landing job and the ledger job compute identical keys, and a retried task
recomputes them identically too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import specs
from reelhouse.plans import catalog
from reelhouse.sources import files, raw


def ingest(
    spark: SparkSession,
    drop_dir: str,
    raw_dir: str,
    ledger_table: str = "default.ingestion_runs",
    glob: str = "*.csv",
    bucket: str = specs.DEFAULT_BUCKET,
    now: dt.datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Land the admitted files of ``drop_dir`` in ``raw_dir`` and record them.

    Returns (ledger rows appended, rejected files with their reason).
    """
    instant = now or dt.datetime.now(dt.timezone.utc)
    instant = (instant.replace(tzinfo=dt.timezone.utc) if instant.tzinfo is None
               else instant.astimezone(dt.timezone.utc))  # a naive `now` is taken as UTC
    # UTC wall clock for the key text, built from text so no zone applies
    wall_utc = F.lit(instant.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    created = F.lit(instant)  # an instant: right in any session time zone
    checked = raw.admit(raw.files_named(raw.list_drop(spark, drop_dir, glob)))
    rejected = checked.where(~F.col("admitted")).select("path", "name", "length", "reason")
    hashed = files.hashed(checked.where("admitted").select("path", "name"))
    # The landing and the ledger see the same hashes: they are written once. A file
    # that changes after that fails the landing.
    keyed = catalog.staged(raw.with_object_key(hashed.withColumn("uploaded_at", wall_utc), "uploaded_at"), "upload")
    raw.land(keyed, raw_dir)
    rows = raw.ledger_rows(
        keyed.withColumns({"created": created, "sent_type": F.lit(specs.DEFAULT_CONTENT_TYPE)}),
        bucket=bucket, created_col="created", content_type_col="sent_type")
    insert_ledger(spark, rows, ledger_table)
    # this upload's rows, read back from the table (not recomputed from the files)
    this_upload = spark.table(ledger_table).where(F.col("created_at") == created).drop(ID_PREFIX)
    return this_upload, rejected


#: The ledger's partitions: the first two digits of the id.
ID_PREFIX = "id_prefix"


def insert_ledger(spark: SparkSession, rows: DataFrame, ledger_table: str, wait_s: float = 60) -> None:
    """Append the rows whose id is not in the ledger yet.

    The ledger is partitioned by the first two digits of the id, and only the
    partitions that the new ids fall in are read. One writer at a time looks and
    appends (``catalog.only_writer``); an insert that was killed is made whole by
    running it again. At most 256 prefixes reach the driver.
    """
    prefix = F.substring("ingestion_id", 1, 2)
    rows = catalog.staged(rows.select(*specs.LEDGER_SCHEMA.fieldNames(), prefix.alias(ID_PREFIX)), "ledger")
    prefixes = sorted(r[0] for r in rows.select(ID_PREFIX).distinct().collect())
    with catalog.only_writer(spark, ledger_table, wait_s):
        if not spark.catalog.tableExists(ledger_table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in specs.LEDGER_SCHEMA.fields)
            spark.sql(f"CREATE TABLE {ledger_table} ({columns}, {ID_PREFIX} string) USING parquet PARTITIONED BY ({ID_PREFIX})")
        elif ID_PREFIX not in spark.table(ledger_table).columns:
            raise ValueError(f"{ledger_table} is not partitioned by {ID_PREFIX}; copy it into a new ledger with insert_ledger")
        if not prefixes:
            return
        # Known partitions show all files in them, also those of an insert that was killed.
        parts = " ".join(f"PARTITION ({ID_PREFIX} = '{p}')" for p in prefixes)
        spark.sql(f"ALTER TABLE {ledger_table} ADD IF NOT EXISTS {parts}")
        spark.catalog.refreshTable(ledger_table)
        fresh = raw.insert_if_absent(touched(spark, ledger_table, prefixes), rows)
        fresh = fresh.select(*spark.table(ledger_table).columns).repartition(ID_PREFIX)
        fresh.write.insertInto(ledger_table)


def touched(spark: SparkSession, ledger_table: str, prefixes: list[str]) -> DataFrame:
    """The ledger's partitions of the given id prefixes."""
    return spark.table(ledger_table).where(F.col(ID_PREFIX).isin(*prefixes))


def upload_set(spark: SparkSession, drop_dir: str, glob: str = "*.csv") -> list[str]:
    """The sorted datasets of the export files in ``drop_dir``; a file name
    that names no dataset stops the run (at most six names come back)."""
    from reelhouse.functions.paths import infer_dataset

    listing = raw.list_drop(spark, drop_dir, glob)
    names = listing.select(infer_dataset("path", strict=True).alias("dataset")).distinct()
    return sorted(r["dataset"] for r in names.collect())
