import os
import time
from decimal import Decimal

import pytest

from reelhouse.plans import catalog, run


def write(path, text, mtime):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    os.utime(path, (mtime, mtime))


def test_layered_run(spark, fresh_layers, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw", "letterboxd")
    t = time.time() - 10000
    # an older ratings file that must be ignored, and the newest one
    write(f"{raw_dir}/2024/01/01/000000_aaa_ratings.csv",
          "Date,Name,Year,Letterboxd URI,Rating\n2020-01-01,Old,1990,u0,1\n", t)
    ratings = ["Date,Name,Year,Letterboxd URI,Rating"]
    for i in range(12):
        ratings.append(f"2024-01-{i + 1:02d},Film {i},{2000 + i % 3},https://f/{i},{1 + i % 5}")
    write(f"{raw_dir}/2024/02/01/000000_bbb_my_ratings.csv", "\n".join(ratings) + "\n", t + 100)
    diary = ["Date,Name,Year,Letterboxd URI,Rating,Rewatch,Tags,Watched Date"]
    for i in range(6):
        diary.append(f"2024-02-0{i + 1},Film {i},2001,https://f/{i},4,No,,2024-0{1 + i % 3}-1{i}")
    write(f"{raw_dir}/2024/02/01/000001_ccc_diary.csv", "\n".join(diary) + "\n", t + 100)
    write(f"{raw_dir}/2024/02/01/000002_ddd_watchlist.csv",
          "Date,Name,Year,Letterboxd URI\n,A,2001,w1\n2024-01-01,A,2001,w1\n2024-01-01,B,2002,w2\n",
          t + 100)
    write(f"{raw_dir}/notes.txt", "not an export", t + 500)

    out = run.run(spark, os.path.join(tmp_dir, "raw"))
    assert sorted(out["bronze"]) == ["diary", "ratings", "watchlist"]
    assert out["bronze"]["ratings"].endswith("my_ratings.csv")
    assert spark.table("bronze.ratings").count() == 12
    assert spark.table("silver.silver_watchlist").count() == 2
    layers = [r.schema_name for r in catalog.list_layers(spark).collect()]
    assert layers == ["bronze", "gold", "silver"]

    top = spark.table("gold.gold_top_rated_movies").collect()
    assert len(top) == 10 and top[0].rating == Decimal("5.0")
    best = spark.table("gold.gold_best_movie_year").collect()
    assert {r.year for r in best} == {2000, 2001, 2002}
    assert spark.table("gold.gold_watch_activity").count() == 3

    report = run.check_layers(spark)
    assert report.count() == 3 + 5 + 3 + 24  # diary, ratings, watchlist and all six marts
    failures = {(r.table_name, r.column_name, r.check_name): r.failures for r in report.collect()}
    # integers like "4" are outside the bronze ratings list ('4.0'), as in the source checks
    assert failures[("ratings", "rating", "accepted_values")] == 5
    assert failures[("gold_top_rated_movies", "letterboxd_uri", "unique")] == 0

    counts = catalog.row_counts({("silver", "silver_ratings"): spark.table("silver.silver_ratings")})
    assert counts.collect()[0].n == 12

    # a second run appends bronze again (append-only), silver dedupes it away
    run.run(spark, os.path.join(tmp_dir, "raw"), datasets=["ratings"])
    assert spark.table("bronze.ratings").count() == 24
    assert spark.table("silver.silver_ratings").count() == 12


def test_layer_name():
    assert catalog.layer_name("silver", "public") == "silver"
    assert catalog.layer_name(None, "public") == "public"
    assert catalog.layer_name("  ", "public") == "public"


def test_run_uploads_drop_folder(spark, tmp_dir):
    drop = os.path.join(tmp_dir, "drop")
    raw_dir = os.path.join(tmp_dir, "raw")
    t = time.time()
    write(f"{drop}/my ratings.csv", "Date,Name,Year,Letterboxd URI,Rating\n2024-01-01,A,2001,u1,4.5\n", t)
    write(f"{drop}/watched.csv", "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2001,u1\n", t)
    write(f"{drop}/empty_diary.csv", "", t)
    write(f"{drop}/notes.txt", "skip me", t)
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze")
    for name in ("ratings", "watched"):
        spark.sql(f"DROP TABLE IF EXISTS bronze.{name}")
    with pytest.raises(ValueError, match="empty_diary.csv: Empty file"):
        run.run(spark, raw_dir, drop_dir=drop, ledger_table="default.runs_ledger")
    assert not spark.catalog.tableExists("bronze.ratings")
    os.remove(f"{drop}/empty_diary.csv")
    out = run.run(spark, raw_dir, drop_dir=drop, ledger_table="default.runs_ledger")
    assert {r.content_type for r in spark.table("default.runs_ledger").collect()} == {"text/csv"}
    assert sorted(out["bronze"]) == ["ratings", "watched"]
    ledger = spark.table("default.runs_ledger").collect()
    assert sorted(r.original_filename for r in ledger) == ["my ratings.csv", "watched.csv"]
    assert all(r.object_key.endswith(r.original_filename.replace(" ", "_")) for r in ledger)
    assert spark.table("silver.silver_ratings").count() == 1


def test_ingest_rejects_and_is_idempotent(spark, tmp_dir):
    import datetime as dt

    from reelhouse.sources import ingest, raw

    drop = os.path.join(tmp_dir, "drop")
    t = time.time()
    write(f"{drop}/a_ratings.csv", "Date,Name,Year,Letterboxd URI,Rating\n", t)
    write(f"{drop}/notes.txt", "x", t)
    now = dt.datetime(2024, 5, 6, 7, 8, 9)
    rows, rejected = ingest.ingest(spark, drop, os.path.join(tmp_dir, "raw"),
                                   "default.ingest_ledger", glob="*", now=now)
    assert [(r.name, r.reason) for r in rejected.collect()] == [("notes.txt", raw.REJECT_NOT_CSV)]
    got = rows.collect()
    assert len(got) == 1 and got[0].object_key.startswith("letterboxd/2024/05/06/070809_")
    assert os.path.exists(os.path.join(tmp_dir, "raw", got[0].object_key))
    # the same upload again adds no ledger row (same content, time and name -> same id)
    ingest.ingest(spark, drop, os.path.join(tmp_dir, "raw"), "default.ingest_ledger", now=now)
    assert spark.table("default.ingest_ledger").count() == 1


def test_ingest_times_do_not_depend_on_session_zone(spark, tmp_dir):
    import datetime as dt

    from reelhouse.sources import ingest

    drop = os.path.join(tmp_dir, "drop")
    write(f"{drop}/z_watched.csv", "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2001,u1\n", time.time())
    now = dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows, _ = ingest.ingest(spark, drop, os.path.join(tmp_dir, "raw"), "default.tz_ledger", now=now)
        row = rows.selectExpr("object_key", "unix_seconds(created_at) AS s").collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row.object_key.startswith("letterboxd/2024/05/06/070809_")
    assert row.s == int(now.timestamp())


def test_load_latest_and_build_layers(spark, tmp_dir):
    import pytest

    from reelhouse.sources import bronze

    raw_dir = os.path.join(tmp_dir, "raw")
    t = time.time() - 1000
    write(f"{raw_dir}/a/old-profile.csv", "Date Joined,Username,Given Name,Family Name,Email Address,"
          "Location,Website,Bio,Pronoun,Favorite Films\n2020-01-01,old,,,,,,,,\n", t)
    write(f"{raw_dir}/b/new_profile.csv", "Date Joined,Username,Given Name,Family Name,Email Address,"
          "Location,Website,Bio,Pronoun,Favorite Films\n2021-01-01,new,,,,,,,,\n", t + 10)
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_l")
    key = bronze.load_latest(spark, raw_dir, "profile", layer="bronze_l")
    assert key.endswith("new_profile.csv")
    assert [r.username for r in spark.table("bronze_l.profile").collect()] == ["new"]
    with pytest.raises(FileNotFoundError):
        bronze.load_latest(spark, raw_dir, "diary", layer="bronze_l")
    built = run.build(spark, "silver", datasets=["profile"], bronze_layer="bronze_l",
                      silver_layer="silver_l")
    assert built == ["silver_l.silver_profile"]
    with pytest.raises(ValueError):
        run.build(spark, "platinum")


def test_run_all_six_datasets(spark, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw6")
    t = time.time() - 100
    files = {
        "ratings.csv": "Date,Name,Year,Letterboxd URI,Rating\n2024-01-01,A,2001,u1,4.5\n2024-01-02,B,,u2,NA\n",
        "watched.csv": "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2001,u1\n,A,2001,u1\n",
        "watchlist.csv": "Date,Name,Year,Letterboxd URI\n2024-01-01,C,1999,u3\n",
        "diary.csv": "Date,Name,Year,Letterboxd URI,Rating,Rewatch,Tags,Watched Date\n"
                     "2024-01-05,A,2001,u1,4.5,No,\"a, b\",2024-01-04\n",
        "reviews.csv": "Date,Name,Year,Letterboxd URI,Rating,Rewatch,Review,Tags,Watched Date\n"
                       "2024-01-05,A,2001,u1,5,Yes,\"Great.\nReally \"\"great\"\".\",,2024-01-04\n",
        "profile.csv": "Date Joined,Username,Given Name,Family Name,Email Address,Location,Website,Bio,"
                       "Pronoun,Favorite Films\n2020-02-02,me,Al,,a@b.c,Here,,\"Line 1\nLine 2\",they,\"x, y\"\n",
    }
    for name, text in files.items():
        write(f"{raw_dir}/export/{name}", text, t)
    out = run.run(spark, raw_dir)
    assert sorted(out["bronze"]) == ["diary", "profile", "ratings", "reviews", "watched", "watchlist"]
    rev = spark.table("silver.silver_reviews").where("letterboxd_uri = 'u1'").collect()
    assert any(r.review == 'Great.\nReally "great".' and r.rewatch is True for r in rev)
    prof = spark.table("silver.silver_profile").where("username = 'me'").collect()[0]
    assert prof.bio == "Line 1\nLine 2" and prof.favorite_films == "x, y" and prof.family_name is None
    report = run.check_layers(spark)
    assert report.count() == 43


def test_incremental_silver_equals_full_rebuild(spark, tmp_dir):
    from reelhouse.plans import silver
    from reelhouse.sources import bronze

    loads = {
        "ratings": [
            "Date,Name,Year,Letterboxd URI,Rating\n2024-01-01,A,2001,u1,4\n2024-01-01,B,2002,u1,4\n"
            ",C,,,3\n2024-01-02,D,2003,u2,\n",
            "Date,Name,Year,Letterboxd URI,Rating\n2024-01-01,A,2000,u1,4\n2024-02-01,A,2001,u1,4.5\n"
            ",B,1999,,3\n2024-01-02,D,2003,u2,\n",
        ],
        "watchlist": [
            "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2001,w1\n2024-01-03,B,2001,w2\n,N,2001,\n",
            "Date,Name,Year,Letterboxd URI\n,A,2001,w1\n2024-01-02,B,2001,w2\n2024-01-01,M,2001,\n",
        ],
        "watched": [
            "Date,Name,Year,Letterboxd URI\n,A,2001,w1\n2024-01-03,B,2001,w2\n2024-01-01,N,2001,\n",
            "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2001,w1\n2024-01-03,A,2001,w2\n",
        ],
    }
    for ds, texts in loads.items():
        for i, text in enumerate(texts):
            path = os.path.join(tmp_dir, f"{i}_{ds}.csv")
            with open(path, "w") as f:
                f.write(text)
            bronze.load_files(spark, path, ds, layer="bronze_inc")
            run.refresh_silver(spark, ds, bronze_layer="bronze_inc", silver_layer="silver_inc")
        full = silver.SILVER_BUILDERS[ds](spark.table(f"bronze_inc.{ds}"))
        inc = spark.table(f"silver_inc.silver_{ds}")
        key = lambda r: repr(tuple(r))
        assert sorted(inc.collect(), key=key) == sorted(full.select(*inc.columns).collect(), key=key), ds


def test_run_incremental(spark, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw_inc")
    write(f"{raw_dir}/x/watchlist.csv", "Date,Name,Year,Letterboxd URI\n2024-03-03,Q,1977,inc-w1\n",
          time.time())
    out = run.run(spark, raw_dir, incremental=True)
    assert "silver.silver_watchlist" in out["silver"]
    got = spark.table("silver.silver_watchlist").where("letterboxd_uri = 'inc-w1'").collect()
    assert [r.name for r in got] == ["Q"]
    assert spark.table("gold.gold_watchlist_by_year").where("year = 1977").count() == 1


def test_incremental_sees_loads_from_outside(spark, tmp_dir):
    from reelhouse.sources import bronze

    raw_dir = os.path.join(tmp_dir, "raw_out")
    hdr = "Date,Name,Year,Letterboxd URI\n"
    t = time.time() - 1000
    for i, name in enumerate("ABC"):
        write(f"{raw_dir}/{i}_watchlist.csv", hdr + f"2024-01-01,{name},2001,out-{name}\n", t + i)
        if name == "B":
            bronze.load_latest(spark, raw_dir, "watchlist")  # silver does not hear of it
        else:
            run.run(spark, raw_dir, incremental=True)
    got = spark.table("silver.silver_watchlist").where("letterboxd_uri LIKE 'out-%'").collect()
    assert sorted(r.name for r in got) == ["A", "B", "C"]


def test_missing_inputs_and_switch_of_kind(spark, tmp_dir):
    with pytest.raises(ValueError, match="bronze_none.diary"):
        run.build(spark, "silver", bronze_layer="bronze_none", silver_layer="silver_none")
    assert run.build(spark, "silver", bronze_layer="bronze_none", silver_layer="silver_none", missing="skip") == []
    src = os.path.join(tmp_dir, "watchlist.csv")
    write(src, "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2001,w1\n", time.time())
    from reelhouse.sources import bronze

    bronze.load_files(spark, src, "watchlist", layer="bronze_k")
    run.build(spark, "silver", datasets=["watchlist"], bronze_layer="bronze_k", silver_layer="silver_k")
    for as_view in (False, True, True, False):
        run.build(spark, "gold", silver_layer="silver_k", gold_layer="gold_k", as_view=as_view, missing="skip")
        kind = spark.catalog.getTable("gold_k.gold_watchlist_by_year").tableType
        assert (kind == "VIEW") == as_view
        assert spark.table("gold_k.gold_watchlist_by_year").count() == 1


def test_run_options_reach_upload_and_load(spark, tmp_dir):
    drop, raw_dir = os.path.join(tmp_dir, "drop"), os.path.join(tmp_dir, "raw")
    hdr = "Date,Name,Year,Letterboxd URI\n"
    write(f"{drop}/a_watched.csv", hdr + "2024-01-01,NA,2001,opt1\n", time.time())
    write(f"{drop}/other.csv", "x\n", time.time())
    out = run.run(spark, raw_dir, datasets=["watched"], drop_dir=drop, ledger_table="default.opt_ledger",
                  glob="*_watched.csv", bucket="b2", load_options={"na_words": False})
    assert sorted(out["bronze"]) == ["watched"]
    assert [r.bucket for r in spark.table("default.opt_ledger").collect()] == ["b2"]
    assert spark.table("bronze.watched").where("letterboxd_uri = 'opt1'").first().name == "NA"
