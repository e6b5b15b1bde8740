"""Checks counted while a table is written, and uniqueness kept up per load."""

from decimal import Decimal

import pytest

from reelhouse.operators import checks, unique_by_load
from reelhouse.plans import catalog, run
from reelhouse.sources import bronze

FILMS = "name string, year int, rating decimal(3,1), letterboxd_uri string"


@pytest.mark.parametrize("rows", [
    [], [("A", 1, Decimal("4.0"), "u")], [(None, None, None, None)] * 2,
    [("A", 1, Decimal("4.2"), None), (None, 2, Decimal("4.2"), "u"), ("B", 3, Decimal("9.5"), "u"), ("C", 4, None, "v")],
])
def test_observed_failures_equal_the_checks(spark, rows):
    name = "gold_top_rated_movies"
    mine = [c for c in checks.DECLARED if c.table == name]
    saved = catalog.save_table(spark.createDataFrame(rows, FILMS).repartition(3), "gold_obs", name, checks=mine)
    report = checks.run_checks({("gold", name): spark.table(saved.table)}, mine).collect()
    full = {(r.column_name, r.check_name): r.failures for r in report}
    assert len(saved.failures) == 4  # all but unique
    assert {(c.column, c.check): n for c, n in saved.failures.items()} == {
        k: n for k, n in full.items() if k[1] != checks.UNIQUE}


def test_only_bounded_checks_are_observed(spark):
    df = spark.createDataFrame([("4",)], "rating string")
    mine = [checks.Check("bronze", "ratings", "rating", checks.ACCEPTED, ("4.0",), True)]
    assert checks.observable(df, mine) == []
    with pytest.raises(ValueError, match="observed"):
        checks.observed(df, mine)


def test_run_tells_the_failures_of_its_marts(spark, fresh_layers, tmp_dir):
    with open(f"{tmp_dir}/watchlist.csv", "w") as f:
        f.write("Date,Name,Year,Letterboxd URI\n2024-01-01,A,2001,w1\n")
    out = run.run(spark, tmp_dir)
    assert out["failures"][("gold_watchlist_by_year", "year", "not_null")] == 0


def test_uniqueness_by_load_equals_the_full_check(spark, tmp_dir):
    header = "Date,Name,Year,Letterboxd URI\n"
    loads = ["2024-01-01,A,2001,u1\n2024-01-02,B,2002,u2\n,,,\n", "2024-01-03,A,2001,u1\n2024-01-04,,2004,u3\n2024-01-04,,2004,u3\n",
             "2024-01-05,C,2005,u2\n2024-01-06,D,,u1\n,,,\n"]
    columns = ["letterboxd_uri", ("name", "year"), "list_date"]

    def full():
        table = spark.table("bronze_u.watched")
        return {",".join([c] if isinstance(c, str) else c): checks.unique(table, c).count() for c in columns}

    for i, text in enumerate(loads):
        with open(f"{tmp_dir}/{i}_watched.csv", "w") as f:
            f.write(header + text)
        bronze.load_files(spark, f"{tmp_dir}/{i}_watched.csv", "watched", "bronze_u", load_id=f"load-{i}")
        got = unique_by_load.refresh(spark, "bronze_u", "watched", columns)
        assert {r.column_name: r.failures for r in got.collect()} == full(), i
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "bronze_u.watched__value_counts" in plan and "bronze_u.watched[" not in plan
        assert not any("/watched/" in p for p in got.inputFiles())
    # counted again after a refresh that was killed: nothing changes
    rows = spark.table("bronze_u.watched").where("load_id = 'load-1'")
    state = unique_by_load.state_name("watched")
    catalog.append_table(unique_by_load.value_counts(rows, columns), "bronze_u", state, load_id="load-1")
    assert {r.column_name: r.failures for r in unique_by_load.refresh(spark, "bronze_u", "watched", columns).collect()} == full()


def test_bucketed_state_is_summed_without_a_shuffle_of_it(spark):
    columns = ["id"]
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_b")
    for i in range(2):
        catalog.append_table(spark.range(1000), "bronze_b", "t", load_id=f"{i}")
    got = unique_by_load.refresh(spark, "bronze_b", "t", columns)
    assert [tuple(r) for r in got.collect()] == [("id", 1000)]
    state = spark.table("bronze_b.t__value_counts")
    sums = state.groupBy("column_name", "digest").sum("n")
    old = spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString(), old
    assert unique_by_load.refresh(spark, "bronze_b", "t", []).count() == 0
