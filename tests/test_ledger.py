"""The ledger under several writers."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from reelhouse import specs
from reelhouse.plans import catalog
from reelhouse.sources import ingest, raw

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)


def rows_of(spark, n, start=0):
    listed = spark.range(start, start + n).select(F.concat(F.lit("k/"), "id").alias("object_key"), F.concat(F.lit("f"), "id").alias("name"),
                                                  F.col("id").alias("size_bytes"), F.lit(NOW).alias("at"))
    return raw.ledger_rows(listed, created_col="at")


def test_two_uploads_of_one_file_leave_one_row(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/drop")
    for name in ("ratings.csv", "_diary.csv"):
        with open(f"{tmp_dir}/drop/{name}", "w") as f:
            f.write("Date,Name\n")
    errors = []

    def upload():
        try:
            ingest.ingest(spark, f"{tmp_dir}/drop", f"{tmp_dir}/raw", "default.two_ledger", now=NOW)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=upload) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    ledger = spark.table("default.two_ledger")
    assert sorted(r.original_filename for r in ledger.collect()) == ["_diary.csv", "ratings.csv"]
    landed = raw.list_raw(spark, f"{tmp_dir}/raw").collect()
    assert sorted(r.path.removeprefix(f"file:{tmp_dir}/raw/") for r in landed) == sorted(r.object_key for r in ledger.collect())


def test_a_held_lock_is_waited_for_and_taken_when_stale(spark):
    with catalog.only_writer(spark, "default.held_ledger"):
        with pytest.raises(RuntimeError, match="nothing was written"):
            ingest.insert_ledger(spark, rows_of(spark, 3), "default.held_ledger", wait_s=0)
        assert not spark.catalog.tableExists("default.held_ledger")
        with catalog.only_writer(spark, "default.held_ledger", wait_s=0, stale_s=-1):
            pass
    ingest.insert_ledger(spark, rows_of(spark, 3), "default.held_ledger", wait_s=0)
    assert spark.table("default.held_ledger").count() == 3


def test_only_touched_partitions_are_read(spark):
    for _ in range(2):
        ingest.insert_ledger(spark, rows_of(spark, 300), "default.part_ledger")
    ledger = spark.table("default.part_ledger")
    assert ledger.count() == 300 and ledger.select("ingestion_id").distinct().count() == 300
    assert ledger.columns == [*specs.LEDGER_SCHEMA.fieldNames(), ingest.ID_PREFIX]
    some = sorted(r[0] for r in ledger.select(ingest.ID_PREFIX).distinct().limit(2).collect())
    read = ingest.touched(spark, "default.part_ledger", some)
    assert "PartitionFilters: [" in read._jdf.queryExecution().executedPlan().toString()
    assert {p.split(f"{ingest.ID_PREFIX}=")[1][:2] for p in read.inputFiles()} == set(some)
    ingest.insert_ledger(spark, rows_of(spark, 10, 295), "default.part_ledger")
    assert spark.table("default.part_ledger").count() == 305
    ingest.insert_ledger(spark, rows_of(spark, 0), "default.part_ledger")
    assert spark.table("default.part_ledger").count() == 305


def test_a_killed_insert_is_made_whole(spark, tmp_dir):
    """Files of an insert that died before its partitions were made known."""
    table = "default.torn_ledger"
    ingest.insert_ledger(spark, rows_of(spark, 0), table)
    rows = rows_of(spark, 5).withColumn(ingest.ID_PREFIX, F.substring("ingestion_id", 1, 2))
    folder = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    rows.where("original_filename < 'f3'").write.mode("append").partitionBy(ingest.ID_PREFIX).parquet(folder)
    ingest.insert_ledger(spark, rows_of(spark, 5), table)
    assert sorted(r.original_filename for r in spark.table(table).collect()) == [f"f{i}" for i in range(5)]
    with pytest.raises(ValueError, match="id_prefix"):
        rows_of(spark, 1).write.saveAsTable("default.flat_ledger")
        ingest.insert_ledger(spark, rows_of(spark, 1), "default.flat_ledger")
