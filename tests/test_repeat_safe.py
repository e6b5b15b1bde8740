"""Loads and rebuilds that are killed at some point and run again."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from reelhouse.plans import catalog, run
from reelhouse.sources import bronze

RATINGS = "Date,Name,Year,Letterboxd URI,Rating\n"
WATCHED = "Date,Name,Year,Letterboxd URI\n"


class Killed(Exception):
    pass


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def die_at(monkeypatch, calls, after):
    """The ``calls``-th call of append_table or save_table dies, before its work or after."""
    count, lock = [0], threading.Lock()

    def wrap(name):
        real = getattr(catalog, name)

        def dies(*args, **kwargs):
            with lock:
                count[0] += 1
                mine = count[0] == calls
            if mine and not after:
                raise Killed
            out = real(*args, **kwargs)
            if mine:
                raise Killed
            return out

        monkeypatch.setattr(catalog, name, dies)

    wrap("append_table")
    wrap("save_table")


@pytest.mark.parametrize("incremental", [False, True])
@pytest.mark.parametrize("calls, after", [(1, True), (2, False), (3, True), (4, True)])
def test_a_killed_run_leaves_each_row_once(spark, fresh_layers, tmp_dir, monkeypatch, calls, after, incremental):
    drop, raw_dir = os.path.join(tmp_dir, "drop"), os.path.join(tmp_dir, "raw")
    write(f"{drop}/ratings.csv", RATINGS + "2024-01-01,A,2001,u1,4\n2024-01-02,B,2002,u2,3\n")
    write(f"{drop}/watched.csv", WATCHED + "2024-01-01,A,2001,u1\n")
    ledger = f"default.killed_{calls}_{after}_{incremental}".lower()
    given = dict(drop_dir=drop, ledger_table=ledger, incremental=incremental, load_id="one",
                 now=dt.datetime(2024, 5, 6, 7, 8, 9))
    with monkeypatch.context() as m:
        die_at(m, calls, after)
        with pytest.raises(Killed):
            run.run(spark, raw_dir, **given)
    for _ in range(2):
        run.run(spark, raw_dir, **given)
        assert sorted(r.name for r in spark.table("bronze.ratings").collect()) == ["A", "B"]
        assert spark.table("bronze.watched").count() == 1
        assert spark.table("silver.silver_ratings").count() == 2
        assert spark.table("silver.silver_watched").count() == 1
        assert spark.table(ledger).count() == 2


def test_incremental_folds_loads_of_every_dataset_and_names_stale_models(spark, fresh_layers, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw")
    write(f"{raw_dir}/1_ratings.csv", RATINGS + "2024-01-01,A,2001,u1,4\n")
    write(f"{raw_dir}/1_watched.csv", WATCHED + "2024-01-01,A,2001,u1\n")
    run.run(spark, raw_dir, incremental=True)
    write(f"{tmp_dir}/other_watched.csv", WATCHED + "2024-01-02,B,2001,u2\n")
    bronze.load_files(spark, f"{tmp_dir}/other_watched.csv", "watched")
    out = run.run(spark, raw_dir, datasets=["ratings"], incremental=True)
    assert spark.table("silver.silver_watched").count() == 2
    assert "silver.silver_watched" not in out["skipped"] and "gold.gold_watch_activity" in out["skipped"]
    spark.sql("DROP TABLE bronze.watched")
    for incremental in (True, False):
        out = run.run(spark, raw_dir, datasets=["ratings"], incremental=incremental)
        assert spark.table("silver.silver_watched").count() == 2  # as it was, and named:
        assert "silver.silver_watched" in out["skipped"]


def test_only_new_partitions_are_read(spark, tmp_dir):
    layers = {"bronze_layer": "bronze_np", "silver_layer": "silver_np"}
    for i in range(3):
        write(f"{tmp_dir}/{i}_watched.csv", WATCHED + f"2024-01-0{i + 1},F{i},2001,u{i}\n")
        bronze.load_files(spark, f"{tmp_dir}/{i}_watched.csv", "watched", "bronze_np", load_id=f"load-{i}")
        if i < 2:
            run.refresh_silver(spark, "watched", **layers)
    assert run.unfolded_loads(spark, "watched", "bronze_np", "silver_np") == ["load-2"]
    fresh = spark.table("bronze_np.watched").where(F.col("load_id").isin("load-2"))
    assert [r.name for r in fresh.collect()] == ["F2"] and len(fresh.inputFiles()) == 1
    run.refresh_silver(spark, "watched", **layers)
    assert spark.table("silver_np.silver_watched").count() == 3
    with pytest.raises(ValueError, match="load id"):
        bronze.load_files(spark, f"{tmp_dir}/0_watched.csv", "watched", "bronze_np", load_id="a/b")


def test_a_failing_build_leaves_the_old_table(spark):
    catalog.save_table(spark.range(3), "versions", "t")
    old = spark.table("versions.t")
    old_files = old.inputFiles()
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("bad row")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="bad row"):
        catalog.save_table(bad, "versions", "t")
    assert sorted(r.id for r in spark.table("versions.t").collect()) == [0, 1, 2]
    # a reader that began on the old version ends on it; the new rows may come from the table itself
    catalog.save_table(spark.table("versions.t").selectExpr("id + 10 AS id"), "versions", "t")
    assert sorted(r.id for r in spark.read.parquet(*old_files).collect()) == [0, 1, 2]
    assert sorted(r.id for r in spark.table("versions.t").collect()) == [10, 11, 12]
    # other columns, and back
    catalog.save_table(spark.table("versions.t").selectExpr("id", "'x' AS x"), "versions", "t")
    assert spark.table("versions.t").columns == ["id", "x"]
    for i in range(4):
        catalog.save_table(spark.range(i), "versions", "t")
        assert spark.table("versions.t").count() == i
    folder = catalog.versions_folder(spark, "versions", "t").removeprefix("file:")
    assert len(os.listdir(folder)) == 2


def test_a_dropped_table_and_a_kept_folder(spark):
    catalog.save_table(spark.range(3), "versions", "d")
    spark.sql("DROP TABLE versions.d")
    catalog.save_table(spark.range(4), "versions", "d")
    assert spark.table("versions.d").count() == 4
