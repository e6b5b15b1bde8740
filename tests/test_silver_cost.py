"""What the silver models cost a row: sorts led by a hash, values read once."""

import re

from reelhouse.operators.dedupe import keep_first
from reelhouse.plans import gold, silver


def plan(df):
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString("formatted"))


def bronze(spark, dataset):
    from reelhouse import specs

    return spark.createDataFrame([], specs.bronze_schema(dataset))


def test_keep_first_sorts_by_the_hash_of_the_key_first(spark):
    for dataset in silver.SILVER_SPECS:
        text = plan(silver.dedupe(bronze(spark, dataset), dataset))
        hashes = set(re.findall(r"hash\([^\n]*?\) AS (_w\d+#\d+)", text))
        sorts = re.findall(r"Sort\nInput [^\n]*\nArguments: \[(_?\w+#\d+)", text)
        assert len(sorts) == 2 and set(sorts) <= hashes, dataset
        assert "row_number(), 1, Partial" in text


def test_pushed_mart_filters_read_a_value_no_more_than_needed(spark):
    """The guard and the cast, the year 0 and the message of a bad value; before: twice as often."""
    for name, column, most in (("gold_top_rated_movies", "rating", 3), ("gold_recent_watch", "watched_date", 4)):
        source, build = gold.GOLD_BUILDERS[name]
        text = plan(build(silver.build_silver(bronze(spark, source), source)))
        pushed = next(c for c in re.findall(r"Condition : ([^\n]*)", text) if "RLIKE" in c)
        assert 1 <= len(re.findall(rf"\b{column}#", pushed)) <= most, pushed


def test_keep_first_groups_what_is_equal(spark):
    nan = float("nan")
    rows = spark.createDataFrame([("a", 0.0, "1.50", 1), ("A", -0.0, "1.5", 2), ("b", nan, None, 3), ("B", nan, None, 4), (None, None, None, 5), (None, None, None, 6)],
                                 "k string, d double, n string, v int").selectExpr("k COLLATE UTF8_LCASE AS k", "d", "CAST(n AS decimal(5,2)) AS n", "v")
    got = keep_first(rows, ["k", "d", "n"], ["v desc"]).collect()
    assert sorted(r.v for r in got) == [2, 4, 6]


def test_blank_guarded_values_are_null(spark):
    b = spark.createDataFrame([(" ", " ", "", " u ", "  ", " ", "", "")], "list_date string, name string, year string, letterboxd_uri string, "
                              "rating string, rewatch string, tags string, watched_date string")
    for on_bad in ("fail", "null"):
        assert [tuple(r) for r in silver.typed_diary(b, on_bad).collect()] == [(None, None, None, "u", None, None, None, None)]
