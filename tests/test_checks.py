from decimal import Decimal

from reelhouse import specs
from reelhouse.operators import checks


def test_accepted_values_text_and_null(spark):
    df = spark.createDataFrame([("4",), ("4.0",), (None,), ("4",), ("5",)], "rating string")
    bad = {r.rating: r.n_records for r in checks.accepted_values(df, "rating", specs.RATING_TEXT_VALUES_RATINGS).collect()}
    assert bad == {"4": 2, "5": 1}
    bad2 = {r.rating for r in checks.accepted_values(df, "rating", specs.RATING_TEXT_VALUES_REVIEWS).collect()}
    assert bad2 == {"4"}


def test_accepted_values_number(spark):
    df = spark.createDataFrame([(Decimal("4.0"),), (Decimal("4.2"),), (None,)], "rating decimal(3,1)")
    bad = [r.rating for r in checks.accepted_values(df, "rating", specs.RATING_NUMBER_VALUES, quote=False).collect()]
    assert bad == [Decimal("4.2")]


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert [tuple(r) for r in checks.unique(df, "k").collect()] == [("a", 2)]
    assert checks.not_null(df, "k").count() == 2


def test_check_table_counts(spark):
    df = spark.createDataFrame(
        [("u1", "A", "4.0"), ("u1", None, "4"), (None, "B", None), ("u2", "C", "9")],
        "letterboxd_uri string, name string, rating string",
    )
    rep = {(r.column_name, r.check_name): r.failures
           for r in checks.run_checks({("bronze", "ratings"): df}).collect()}
    assert rep == {
        ("letterboxd_uri", "not_null"): 1,
        ("letterboxd_uri", "unique"): 1,
        ("name", "not_null"): 1,
        ("rating", "not_null"): 1,
        ("rating", "accepted_values"): 2,
    }


def test_check_table_on_empty_and_null_only_tables(spark):
    empty = spark.createDataFrame([], "letterboxd_uri string, name string, watched_date string, rating string")
    for t, n in (("ratings", 5), ("diary", 3), ("reviews", 3)):
        assert [r.failures for r in checks.run_checks({("bronze", t): empty}).collect()] == [0] * n
    df = spark.createDataFrame([(None, "A", None), (None, None, "2024-01-01"), ("u", "B", None)],
                               "letterboxd_uri string, name string, watched_date string")
    rep = {r.column_name: r.failures for r in checks.run_checks({("bronze", "diary"): df}).collect()}
    assert rep == {"letterboxd_uri": 2, "name": 1, "watched_date": 2}


def test_declared_count():
    assert len(checks.DECLARED) == 43
    assert sum(c.layer == "bronze" for c in checks.DECLARED) == 19


def test_reviews_list_rejects_5_0(spark):
    df = spark.createDataFrame([("5.0",), ("5",), ("4.5",)], "rating string")
    bad = [r.rating for r in checks.accepted_values(df, "rating", specs.RATING_TEXT_VALUES_REVIEWS).collect()]
    assert bad == ["5.0"]


def test_check_ledger_violations(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [
        ("id1", "s", "a.csv", "raw", "k1", 10, None, "uploaded", t, t),
        ("id1", "s", "b.csv", "raw", "k2", 10, None, "uploaded", t, t),   # same id twice
        ("id2", "s", "c.csv", "raw", "k3", -5, None, "uploaded", t, t),   # negative size
        ("id3", "s", "d.csv", "raw", "k3", 7, None, None, t, t),          # same key, other id; NULL status
    ]
    ledger = spark.createDataFrame(rows, specs.LEDGER_SCHEMA.simpleString().replace("struct<", "").rstrip(">")
                                   .replace(":", " "))
    rep = {(r.check_name, r.column_name): r.failures for r in checks.check_ledger(ledger).collect()}
    assert rep[("primary_key", "ingestion_id")] == 1
    assert rep[("unique", "bucket,object_key")] == 1
    assert rep[("size_bytes_non_negative", "size_bytes")] == 1
    assert rep[("not_null", "status")] == 1
    assert rep[("not_null", "source")] == 0
