import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from reelhouse.operators.dedupe import keep_first
from reelhouse.plans import gold, silver

FILM = "list_date string, name string, year string, letterboxd_uri string"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_watchlist_null_date_wins_watched_null_loses(spark):
    data = [
        ("", "A", "2001", "u1"),
        ("2024-01-05", "A", "2001", "u1"),
        ("2024-01-01", "A", "2001", "u1"),
    ]
    b = spark.createDataFrame(data, FILM)
    wl = silver.silver_watchlist(b).collect()
    wd = silver.silver_watched(b).collect()
    assert [r.list_date for r in wl] == [None]
    assert [r.list_date for r in wd] == [dt.date(2024, 1, 5)]


def test_null_keys_group_and_drop_rules(spark):
    data = [
        ("2024-01-01", "A", "2001", " "),
        ("2024-01-02", "B", "2001", ""),
        ("2024-01-03", "C", "2001", "u1"),
    ]
    b = spark.createDataFrame(data, FILM)
    # watchlist keeps one NULL-URI row; watched drops NULL URIs.
    assert len(silver.silver_watchlist(b).collect()) == 2
    assert len(silver.silver_watched(b).collect()) == 1


def test_ratings_ties_are_deterministic_and_idempotent(spark):
    data = [
        ("2024-01-01", "Zed", "2001", "u1", "4"),
        ("2024-01-01", "Abe", None, "u1", "4.0"),
        ("2024-01-01", "Abe", "1999", "u1", "4"),
        ("2024-01-02", "Abe", "1999", "u1", "4"),
    ]
    b = spark.createDataFrame(data, FILM + ", rating string")
    out = silver.silver_ratings(b)
    got = rows(out, "list_date", "name", "year", "rating")
    assert got == sorted([
        (dt.date(2024, 1, 1), "Abe", 1999, Decimal("4.0")),
        (dt.date(2024, 1, 2), "Abe", 1999, Decimal("4.0")),
    ], key=repr)
    # silver(b union b) == silver(b), and input order does not matter
    twice = silver.silver_ratings(b.unionByName(b).orderBy(F.rand(7)))
    assert rows(twice, *out.columns) == rows(out, *out.columns)


def test_diary_rewatch_blank_is_null(spark):
    cols = FILM + ", rating string, rewatch string, tags string, watched_date string"
    b = spark.createDataFrame(
        [("2024-01-01", "A", "2001", "u1", "4", "", "t", "2024-01-01"),
         ("2024-01-01", "A", "2001", "u2", "4", " Yes ", "t", "2024-01-01")],
        cols,
    )
    got = {r.letterboxd_uri: r.rewatch for r in silver.silver_diary(b).collect()}
    assert got == {"u1": None, "u2": True}


def test_keep_first_hot_key(spark):
    # one key holds most rows; the result is still one row per key
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    out = keep_first(df, ["k"], ["v desc"])
    assert out.count() == 20000 - 6667 + 1
    assert out.where("k = 'hot'").collect()[0].v == 19998


def ratings_silver(spark, data):
    return spark.createDataFrame(
        data, "list_date date, name string, year int, letterboxd_uri string, rating decimal(3,1)"
    )


def test_top_rated_null_year_first(spark):
    s = ratings_silver(spark, [
        (None, "B", 2000, "u1", Decimal("5.0")),
        (None, "A", None, "u2", Decimal("5.0")),
        (None, None, 2000, "u3", Decimal("5.0")),
        (None, "C", 1990, "u4", Decimal("4.5")),
        (None, "D", 1990, "u5", None),
    ])
    top = gold.gold_top_rated_movies(s).collect()
    assert [r.letterboxd_uri for r in top] == ["u2", "u1", "u3", "u4"]
    low = gold.gold_lowest_rated_movie(s).collect()
    assert [r.letterboxd_uri for r in low] == ["u4"]


def test_top_rated_empty(spark):
    s = ratings_silver(spark, [])
    assert gold.gold_top_rated_movies(s).collect() == []


def test_best_year_having_and_mean(spark):
    s = ratings_silver(spark, [
        (None, "a", 2000, "u1", Decimal("4.0")),
        (None, "b", 2000, "u2", Decimal("3.5")),
        (None, "c", 2001, "u3", Decimal("1.0")),
        (None, "d", 2001, "u4", Decimal("1.5")),
        (None, "e", 2001, "u5", Decimal("1.5")),
        (None, "f", None, "u6", Decimal("5.0")),
    ])
    got = [tuple(r) for r in gold.gold_best_movie_year(s).collect()]
    assert got == [(2001, 3, Decimal("1.33"))]


def test_watch_activity_and_recent(spark):
    d = spark.createDataFrame(
        [("A", 2000, dt.date(2024, 1, 5), Decimal("4.0"), True, "u1"),
         ("B", 2000, dt.date(2024, 1, 20), None, None, "u2"),
         (None, 2000, dt.date(2024, 3, 1), None, None, "u3"),
         ("C", 2000, dt.date(2024, 3, 1), None, None, "u4"),
         ("D", 2000, None, None, None, "u5")],
        "name string, year int, watched_date date, rating decimal(3,1), rewatch boolean, letterboxd_uri string",
    )
    act = [tuple(r) for r in gold.gold_watch_activity(d).collect()]
    assert act == [(dt.date(2024, 1, 1), 2), (dt.date(2024, 3, 1), 2)]
    assert gold.gold_recent_watch(d).collect()[0].letterboxd_uri == "u4"


def test_rerated_film_kept_twice_and_flagged(spark):
    # The ratings dedupe key holds list_date and rating, so a film rated
    # again appears twice in silver (and can fail the unique check on gold).
    from reelhouse.operators import checks

    b = spark.createDataFrame(
        [("2024-01-01", "A", "2001", "u1", "3"), ("2024-02-01", "A", "2001", "u1", "4.5"),
         ("2024-02-01", "A", "2001", "u1", "4.5")],
        FILM + ", rating string",
    )
    s = silver.silver_ratings(b)
    assert s.count() == 2
    top = gold.gold_top_rated_movies(s)
    assert [tuple(r) for r in checks.unique(top, "letterboxd_uri").collect()] == [("u1", 2)]


def test_sort_spec_parsing(spark):
    import pytest

    from reelhouse.operators.order import key

    assert "NULLS FIRST" in str(key("year desc"))
    assert "NULLS LAST" in str(key("name asc"))
    assert "NULLS LAST" in str(key("name"))
    assert "NULLS FIRST" in str(key("d asc nulls first"))
    for bad in ("", "a nulls", "a sideways", "a desc nulls"):
        with pytest.raises(ValueError):
            key(bad)
