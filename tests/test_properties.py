"""Property tests: the dedupe against brute force, silver idempotence."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelhouse.operators.dedupe import keep_first
from reelhouse.plans import silver

KEYS = st.sampled_from(["a", "b", "c", None])
DATES = st.one_of(st.none(), st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2024, 1, 4)))
NAMES = st.sampled_from(["x", "y", None])
ROWS = st.lists(st.tuples(KEYS, DATES, NAMES), min_size=0, max_size=25)


def brute_keep_first(rows, nulls_first: bool):
    """Per key: list_date descending (NULLs first or last), then name ascending NULLs last."""
    out = {}
    for k, d, n in rows:
        out.setdefault(k, []).append((k, d, n))

    def rank(r):
        _, d, n = r
        d_null = d is None
        d_key = (0 if d_null else 1) if nulls_first else (1 if d_null else 0)
        return (d_key, -(d.toordinal()) if d else 0, n is None, n or "")

    return sorted((min(g, key=rank) for g in out.values()), key=repr)


SCHEMA = "k string, d date, n string"
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(ROWS, st.booleans())
def test_keep_first_matches_brute_force(spark, rows, nulls_first):
    df = spark.createDataFrame(rows, SCHEMA)
    order = ["d desc nulls first" if nulls_first else "d desc nulls last"]
    got = sorted((tuple(r) for r in keep_first(df, ["k"], order).collect()), key=repr)
    assert got == brute_keep_first(rows, nulls_first)


FILM_ROWS = st.lists(
    st.tuples(
        st.sampled_from(["2024-01-01", "2024-01-02", "", " 2024-01-03 ", "soon", None]),
        st.sampled_from(["A", "B", " ", None]),
        st.sampled_from(["2001", "2001.0", "", None]),
        st.sampled_from(["u1", "u2", " ", None]),
    ),
    max_size=20,
)


@SETTINGS
@given(FILM_ROWS)
def test_silver_idempotent_and_order_free(spark, rows):
    b = spark.createDataFrame(rows, "list_date string, name string, year string, letterboxd_uri string")
    for build in (silver.silver_watchlist, silver.silver_watched):
        once = sorted((tuple(r) for r in build(b).collect()), key=repr)
        twice = sorted((tuple(r) for r in build(b.unionByName(b)).collect()), key=repr)
        flipped = sorted((tuple(r) for r in build(spark.createDataFrame(rows[::-1], b.schema)).collect()), key=repr)
        assert once == twice == flipped


SUITE_ROWS = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", "u3", None]),
        st.sampled_from(["A", None]),
        st.sampled_from(["4.0", "4", "5.0", "0.5", None]),
    ),
    max_size=30,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(SUITE_ROWS)
def test_check_suite_equals_single_checks(spark, rows):
    from reelhouse.operators import checks

    df = spark.createDataFrame(rows, "letterboxd_uri string, name string, rating string")
    suite = {(r.column_name, r.check_name): r.failures
             for r in checks.run_checks({("bronze", "ratings"): df}).collect()}
    expected = {}
    for c in checks.DECLARED:
        if (c.layer, c.table) != ("bronze", "ratings"):
            continue
        if c.check == checks.NOT_NULL:
            n = checks.not_null(df, c.column).count()
        elif c.check == checks.UNIQUE:
            n = checks.unique(df, c.column).count()
        else:
            n = checks.accepted_values(df, c.column, c.values, c.quote).count()
        expected[(c.column, c.check)] = n
    assert suite == expected


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(FILM_ROWS, FILM_ROWS, st.sampled_from(["watched", "watchlist"]))
def test_fold_equals_full_rebuild(spark, first, second, dataset):
    schema = "list_date string, name string, year string, letterboxd_uri string"
    b1 = spark.createDataFrame(first, schema)
    b2 = spark.createDataFrame(second, schema)
    folded = silver.fold(silver.build_silver(b1, dataset), b2, dataset)
    full = silver.build_silver(b1.unionByName(b2), dataset)
    key = lambda r: repr(tuple(r))
    assert sorted(folded.collect(), key=key) == sorted(full.collect(), key=key)
