import datetime as dt
import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from reelhouse.functions.paths import infer_dataset
from reelhouse.operators.checks import check_ledger
from reelhouse.sources import files, raw


@pytest.mark.parametrize(
    "name,want",
    [
        ("ratings.csv", "ratings"),
        ("letterboxd_ratings.csv", "ratings"),
        ("my-Watched.CSV", "watched"),
        ("a watchlist.csv", "watchlist"),
        ("_ratings.csv", "ratings"),
        ("dir/sub/x_diary.csv", "diary"),
        ("xratings.csv", None),
        ("unwatched.csv", None),
        ("ratings.txt", None),
        ("ratings", None),
    ],
)
def test_infer_dataset(spark, name, want):
    df = spark.createDataFrame([(name,)], "path string")
    assert df.select(infer_dataset("path")).collect()[0][0] == want


def test_infer_dataset_strict(spark):
    df = spark.createDataFrame([("ratings",), ("x_profile.csv",)], "path string")
    assert [r[0] for r in df.select(infer_dataset("path", strict=True)).collect()] == ["ratings", "profile"]
    bad = spark.createDataFrame([("notes.csv",)], "path string")
    with pytest.raises(Exception, match="No dataset can be told from the file name"):
        bad.select(infer_dataset("path", strict=True)).collect()


def write(path, data: bytes, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_listing_latest_and_missing(spark, tmp_dir):
    t0 = time.time() - 1000
    write(f"{tmp_dir}/letterboxd/a/1_ratings.csv", b"x", t0)
    write(f"{tmp_dir}/letterboxd/b/2_ratings.csv", b"xy", t0 + 10)
    write(f"{tmp_dir}/letterboxd/b/c/0_ratings.csv", b"xyz", t0 + 10)  # same time, smaller path? no: '.../b/2' < '.../b/c'
    write(f"{tmp_dir}/letterboxd/diary.csv", b"d", t0)
    write(f"{tmp_dir}/letterboxd/notes.txt", b"n", t0 + 50)
    listing = raw.list_raw(spark, f"{tmp_dir}/letterboxd")
    assert listing.count() == 5
    assert "content" not in listing.columns
    latest = {r.dataset: r.path for r in raw.latest_objects(listing).collect()}
    assert latest["ratings"].endswith("/b/2_ratings.csv")
    assert latest["diary"].endswith("/diary.csv")
    one = raw.latest_key(raw.latest_object(listing, "ratings"), "ratings")
    assert one.endswith("/b/2_ratings.csv")
    with pytest.raises(FileNotFoundError):
        raw.latest_key(raw.latest_object(listing, "profile"), "profile")
    assert raw.available_dataset_names(listing) == ["diary", "ratings"]
    assert raw.latest_by_suffix(listing, ".TXT").collect()[0].path.endswith("notes.txt")
    assert raw.list_raw(spark, f"{tmp_dir}/nope").count() == 0
    drop = raw.list_drop(spark, f"{tmp_dir}/letterboxd", "*.csv").collect()
    assert [os.path.basename(r.path) for r in drop] == ["diary.csv"]
    assert raw.list_drop(spark, f"{tmp_dir}/missing").count() == 0


def test_admit_fingerprint_key_land_ledger(spark, tmp_dir):
    given = spark.createDataFrame(
        [("my ratings.csv", bytearray(b"Date,Name\n")), ("notes.txt", bytearray(b"x")),
         ("empty.CSV", bytearray(b""))],
        "name string, content binary",
    ).withColumn("length", F.octet_length("content"))
    adm = {r.name: (r.admitted, r.reason) for r in raw.admit(given).collect()}
    assert adm == {
        "my ratings.csv": (True, None),
        "notes.txt": (False, raw.REJECT_NOT_CSV),
        "empty.CSV": (False, raw.REJECT_EMPTY),
    }
    ok = raw.fingerprint(raw.admit(given).where("admitted"))
    ts = spark.createDataFrame([(dt.datetime(2024, 3, 9, 7, 8, 9),)], "ts timestamp")
    keyed = raw.with_object_key(ok.crossJoin(ts), "ts")  # one row on each side
    row = keyed.collect()[0]
    sha = hashlib.sha256(b"Date,Name\n").hexdigest()
    assert row.sha256 == sha and row.size_bytes == 10
    assert row.object_key == f"letterboxd/2024/03/09/070809_{sha[:12]}_my_ratings.csv"
    ledger = raw.ledger_rows(keyed)
    r = ledger.collect()[0]
    assert r.status == "uploaded" and r.bucket == "raw" and r.size_bytes == 10
    assert len(r.ingestion_id) == 36
    # insert twice: the second time nothing is new
    new = raw.insert_if_absent(ledger.limit(0), ledger.unionByName(ledger))
    assert new.count() == 1
    assert raw.insert_if_absent(ledger, ledger).count() == 0
    report = {(x.check_name, x.column_name): x.failures for x in check_ledger(ledger).collect()}
    assert set(report.values()) == {0}


def test_recent_runs(spark):
    df = spark.createDataFrame(
        [(str(i), dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(15)]
        + [("n", None)],
        "ingestion_id string, created_at timestamp",
    )
    got = [r.ingestion_id for r in raw.recent_runs(df, 3).collect()]
    assert got == ["n", "14", "13"]


def test_object_key_is_utc_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame(
            [(dt.datetime(2024, 3, 9, 7, 8, 9, tzinfo=dt.timezone.utc), "ab" * 32, "a b.csv")],
            "ts timestamp, sha256 string, name string",
        )
        key = raw.with_object_key(df, "ts").collect()[0].object_key
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert key == "letterboxd/2024/03/09/070809_abababababab_a_b.csv"


def test_every_file_is_listed(spark, tmp_dir):
    names = ["1_ratings.csv", "2_ratings.csv", "_ratings.csv", ".x-diary.csv", "a/_b/watched.csv", "a/.c/d/e/f/[g]{h}* ratings.csv", "notes"]
    for i, name in enumerate(names):
        write(f"{tmp_dir}/raw/{name}", b"" if i % 2 else b"x\n", 1000 + i)
    write(f"{tmp_dir}/raw/{files.TEMPORARY}0.ratings.csv", b"part")
    got = raw.list_raw(spark, f"{tmp_dir}/raw").collect()
    assert sorted((r.path, r.modificationTime.timestamp(), r.length) for r in got) == sorted(
        (f"file:{tmp_dir}/raw/{name}", 1000 + i, 0 if i % 2 else 2) for i, name in enumerate(names))
    listing = raw.list_raw(spark, f"{tmp_dir}/raw")
    assert raw.latest_key(raw.latest_object(listing, "watched"), "x").endswith("a/_b/watched.csv")
    drop = raw.list_drop(spark, f"{tmp_dir}/raw", "*ratings.csv").collect()
    assert [os.path.basename(r.path) for r in drop] == ["1_ratings.csv", "2_ratings.csv", "_ratings.csv"]


def test_wide_trees_are_listed_by_many_tasks(spark, tmp_dir):
    for i in range(100):
        write(f"{tmp_dir}/raw/{i % 3}/{i}/{i % 2}/{i}.csv", b"")
    write(f"{tmp_dir}/raw/top.csv", b"")
    listing = raw.list_raw(spark, f"{tmp_dir}/raw")
    parts = files.FileListingReader(f"file:{tmp_dir}/raw", True, None).partitions()
    assert len(parts) == 1 + 3 + 100 and sum(not p.recursive for p in parts) == 4
    assert sorted(os.path.basename(r.path) for r in listing.collect()) == sorted([f"{i}.csv" for i in range(100)] + ["top.csv"])


def test_files_are_hashed_and_copied_in_blocks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(files, "BLOCK", 7)  # blocks() runs in this process below
    for size in (0, 1, 6, 7, 8, 1000):
        data = bytes(range(256)) * 4
        write(f"{tmp_dir}/in/{size} #%.csv", data[:size])
        assert b"".join(files._blocks(f"file:{tmp_dir}/in/{size} #%.csv")) == data[:size]
    listed = raw.files_named(raw.list_drop(spark, f"{tmp_dir}/in"))
    keyed = files.hashed(listed).withColumn("object_key", F.concat(F.lit("a/b/"), "name"))
    rows = keyed.collect()
    assert {(r.name, r.size_bytes, r.sha256) for r in rows} == {
        (f"{s} #%.csv", s, hashlib.sha256((bytes(range(256)) * 4)[:s]).hexdigest()) for s in (0, 1, 6, 7, 8, 1000)}
    keyed = spark.createDataFrame(rows, keyed.schema)
    for _ in range(2):
        raw.land(keyed, f"{tmp_dir}/out")
        landed = raw.list_raw(spark, f"{tmp_dir}/out").collect()
        assert {os.path.basename(r.path): r.length for r in landed} == {r.name: r.size_bytes for r in rows}
        assert all(not n.startswith(files.TEMPORARY) for n in os.listdir(f"{tmp_dir}/out/a/b"))
    write(f"{tmp_dir}/in/8 #%.csv", b"changed")
    with pytest.raises(Exception, match="changed while it was uploaded"):
        raw.land(keyed, f"{tmp_dir}/out2")


def test_arrow_uri():
    import pytest

    assert files.arrow_uri("s3a://b/raw") == "s3://b/raw"
    assert files.arrow_uri("/data/raw") == "/data/raw"
    assert files.arrow_uri("file:/data/raw") == files.arrow_uri("file:///data/raw") == "/data/raw"
    assert files.arrow_uri("hdfs://n:1/raw") == "hdfs://n:1/raw"
    with pytest.raises(ValueError, match="ftp"):
        files.arrow_uri("ftp://h/raw")
