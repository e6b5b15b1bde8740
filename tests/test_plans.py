"""Plan-shape checks: the scale properties the design relies on."""

import re

import pytest

from reelhouse import registry

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(fn(spark, SF)) for name, fn in registry.QUERIES.items()}


def test_no_python_udf_no_cartesian(plans):
    for name, text in plans.items():
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin", "MapInPandas", "FlatMapGroupsInPandas"):
            assert bad not in text, (name, bad)


def tree(text: str) -> str:
    return text.split("\n\n\n")[0]


@pytest.mark.parametrize("name", ["silver_ratings", "silver_diary", "silver_reviews", "silver_watched",
                                  "silver_watchlist", "silver_profile", "latest_object"])
def test_dedupe_limits_before_the_shuffle(plans, name):
    lines = tree(plans[name]).splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    assert len(limits) == 2, name  # final above the exchange, partial below it
    between = lines[limits[0] + 1:limits[1]]
    assert any("Exchange" in line for line in between), name
    assert "row_number(), 1, Partial" in plans[name], name


@pytest.mark.parametrize("name", ["gold_top_rated_movies", "gold_lowest_rated_movie",
                                  "gold_recent_watch", "recent_runs", "latest_12_months"])
def test_top_k_without_global_sort(plans, name):
    assert "TakeOrderedAndProject" in plans[name]


@pytest.mark.parametrize("name", ["gold_best_movie_year", "gold_watch_activity",
                                  "gold_watchlist_by_year", "check_suite", "check_unique"])
def test_partial_aggregation(plans, name):
    assert len(re.findall(r"HashAggregate", tree(plans[name]))) >= 2


def test_check_suite_unpivots_value_columns_only(spark):
    from reelhouse.operators import checks

    df = spark.createDataFrame([("u", "n", "4.0", "2024-01-01")], "letterboxd_uri string, name string, rating string, watched_date string")
    generates = {t: tree(plan(checks.run_checks({("bronze", t): df}))).count("Generate") for t in ("diary", "watched", "ratings")}
    # The report itself is one; only a table with two value columns is unpivoted.
    assert generates == {"diary": 1, "watched": 1, "ratings": 2}
    text = plan(checks.run_checks({("bronze", "diary"): df}))
    assert "hashpartitioning" not in text  # NULL counts alone are one plain aggregate


def test_check_ledger_scans_twice(spark):
    from reelhouse import specs
    from reelhouse.operators import checks

    ledger = spark.createDataFrame([], specs.LEDGER_SCHEMA)
    assert len(re.findall(r"Scan ExistingRDD", tree(plan(checks.check_ledger(ledger))))) == 2


def test_scans_are_pruned(plans):
    schema = re.findall(r"ReadSchema: (struct<[^\n]*>)", plans["silver_ratings"])[0]
    assert schema.count(":") == 5  # 5 of lineitem's 11 columns
    schema = re.findall(r"ReadSchema: (struct<[^\n]*>)", plans["fingerprint"])[0]
    assert "doc_id" in schema and "text" in schema and "lang" not in schema
