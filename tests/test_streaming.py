import os

from reelhouse.streaming.landing import stream_bronze


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_stream_loads_each_file_once(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    ckpt = os.path.join(tmp_dir, "ckpt")
    hdr = "Date,Name,Year,Letterboxd URI,Rating\n"
    write(f"{raw}/a/1_ratings.csv", hdr + "2024-01-01,A,2001,u1,4\n")
    write(f"{raw}/a/2_ratings.csv", hdr + "2024-01-02,B,2002,u2,3\n2024-01-03,C,2003,u3,5\n")
    write(f"{raw}/a/notes.csv", "x\n")
    q = stream_bronze(spark, raw, layer="bronze_s", checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.table("bronze_s.ratings").count() == 3
    # a new file arrives; a second run loads only that one
    write(f"{raw}/b/3_my_ratings.csv", hdr + "2024-01-04,D,2004,u4,2\n")
    q = stream_bronze(spark, raw, layer="bronze_s", checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.table("bronze_s.ratings").count() == 4
    assert spark.table("bronze_s.bronze_load_log").count() == 3


def test_stream_keeps_silver_current(spark, tmp_dir):
    from reelhouse.plans import silver

    raw = os.path.join(tmp_dir, "raw")
    ckpt = os.path.join(tmp_dir, "ckpt")
    hdr = "Date,Name,Year,Letterboxd URI\n"
    write(f"{raw}/1_watchlist.csv", hdr + "2024-01-01,A,2001,w1\n2024-01-05,B,2002,w2\n")
    stream_bronze(spark, raw, layer="bronze_ss", checkpoint=ckpt, silver_layer="silver_ss").awaitTermination(120)
    write(f"{raw}/2_watchlist.csv", hdr + ",A,2001,w1\n2024-01-02,B,2002,w2\n2024-01-09,C,2003,w3\n")
    stream_bronze(spark, raw, layer="bronze_ss", checkpoint=ckpt, silver_layer="silver_ss").awaitTermination(120)
    full = silver.silver_watchlist(spark.table("bronze_ss.watchlist"))
    got = spark.table("silver_ss.silver_watchlist")
    key = lambda r: repr(tuple(r))
    assert sorted(got.collect(), key=key) == sorted(full.collect(), key=key)
    assert got.count() == 3


def test_bad_file_and_restarts_leave_each_row_once(spark, tmp_dir):
    import pytest

    from reelhouse.streaming import landing

    raw = os.path.join(tmp_dir, "raw")
    ckpt = os.path.join(tmp_dir, "ckpt")
    hdr = "Date,Name,Year,Letterboxd URI,Rating\n"
    write(f"{raw}/1_ratings.csv", hdr + "2024-01-01,A,2001,u1,4\n")
    # columns in another order, and old Mac line ends (one "line" for a plain reader)
    write(f"{raw}/[2]_ratings.csv", "Rating,Date,Name,Year,Letterboxd URI\r5,2024-01-02,B,2002,u2\r")
    write(f"{raw}/9_watched.csv", "Date,Name\n2024-01-01,A\n")  # lacks columns
    for _ in range(3):
        with pytest.raises(Exception, match="lacks the columns"):
            stream_bronze(spark, raw, layer="bronze_r", checkpoint=ckpt).awaitTermination(120)
        assert not spark.catalog.tableExists("bronze_r.ratings")
    write(f"{raw}/9_watched.csv", "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2001,u1\n")
    files = spark.createDataFrame(
        [(f"{raw}/{n}",) for n in ("1_ratings.csv", "[2]_ratings.csv", "9_watched.csv")], "path string")
    # die after the append, before the log entry
    real = landing._write_log

    def dies(spark, layer, rows):
        raise OSError("lost")

    landing._write_log = dies
    try:
        for _ in range(2):
            with pytest.raises(OSError):
                landing.load_batch(spark, files, 0, "bronze_r", "silver_r")
    finally:
        landing._write_log = real
    assert landing.load_batch(spark, files, 0, "bronze_r", "silver_r") == 3
    assert landing.load_batch(spark, files, 0, "bronze_r", "silver_r") == 0
    got = sorted((r.name, r.rating) for r in spark.table("bronze_r.ratings").collect())
    assert got == [("A", "4"), ("B", "5")]
    assert spark.table("bronze_r.watched").count() == 1
    assert spark.table("silver_r.silver_ratings").count() == 2
