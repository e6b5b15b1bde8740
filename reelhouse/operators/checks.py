"""Declared data checks: not_null, unique, accepted_values, and a suite runner.

A check returns its failing rows (pass = none), with the same meaning as the
warehouse's generic tests: ``not_null`` returns the NULL rows; ``unique``
returns each non-NULL value seen more than once with its count;
``accepted_values`` returns each distinct value outside the list with its count,
and NULL passes (``NULL NOT IN (..)`` is not true).

The suite counts failures per check. Per table it scans once and counts the
(column, value) pairs of the columns that unique or accepted_values needs; a
column that only needs not_null is a sum of NULL flags beside them. The partial
aggregation means a value held by a third of the rows still sends one row per
map task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse import specs

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"
REPORT_COLUMNS = ["layer", "table_name", "column_name", "check_name", "failures"]


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Q2: non-NULL values (or value tuples) seen more than once, with ``n_records``."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    return (
        df.where(present)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def _accepted(col: Column, values: Sequence, quote: bool) -> Column:
    if quote:
        return col.cast("string").isin(*[str(v) for v in values])
    return col.isin(*[F.lit(Decimal(str(v))) if not isinstance(v, Decimal) else F.lit(v)
                      for v in values])


def accepted_values(df: DataFrame, column: str, values: Sequence, quote: bool = True) -> DataFrame:
    """Q3: distinct values outside ``values`` with ``n_records``; NULL passes.

    ``quote=True`` compares as text, ``quote=False`` as numbers.
    """
    grouped = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return grouped.where(~_accepted(F.col(column), values, quote))


@dataclass(frozen=True)
class Check:
    layer: str
    table: str
    column: str
    check: str
    values: tuple = field(default=())
    quote: bool = True


def _report_row(layer: str, table: str, column: str, check: str, failures: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        failures.cast("long").alias("failures"),
    )


def check_table(df: DataFrame, checks: Sequence[Check]) -> DataFrame | None:
    """Failure counts of the checks declared on one table, in one scan.

    Columns that unique or accepted_values needs are counted by value; of
    several, each row makes one (column number, value) pair per column. Columns that
    only need a NULL count are summed beside them, on the pairs of the first
    column alone, and a table without other checks is one plain aggregate.
    Partial aggregation keeps the shuffle to one row per distinct pair and map
    task; one final aggregate turns the counts into one failure count per check.
    """
    by_col: dict[str, list[Check]] = {}
    for c in checks:
        by_col.setdefault(c.column, []).append(c)
    if not by_col:
        return None
    valued = [col for col, cs in by_col.items() if any(c.check != NOT_NULL for c in cs)]
    nulls = {col: f"null_{i}" for i, col in enumerate(c for c in by_col if c not in valued)}
    flags = [F.col(col).isNull().cast("long").alias(name) for col, name in nulls.items()]
    if not valued:
        grouped = df.select(*flags)
    else:
        pairs = [
            [F.lit(i).alias("c"), F.col(col).cast("string").alias("v")]
            + (flags if i == 0 else [F.lit(0).cast("long").alias(name) for name in nulls.values()])
            for i, col in enumerate(valued)
        ]
        unpivoted = (
            df.select(*pairs[0]) if len(pairs) == 1
            else df.select(F.inline(F.array(*[F.struct(*p) for p in pairs])))
        )
        grouped = unpivoted.groupBy("c", "v").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in nulls.values()]
        )
    v, n = F.col("v"), F.col("n")
    rows = []
    for col, cs in by_col.items():
        mine = F.col("c") == valued.index(col) if col in valued else None
        for c in cs:
            if c.check == NOT_NULL and col in nulls:
                failures = F.coalesce(F.sum(nulls[col]), F.lit(0))
            elif c.check == NOT_NULL:
                failures = F.coalesce(F.sum(F.when(mine & v.isNull(), n)), F.lit(0))
            elif c.check == UNIQUE:
                failures = F.count(F.when(mine & v.isNotNull() & (n > 1), 1))
            elif c.check == ACCEPTED:
                typed = v if c.quote else v.cast("decimal(38,10)")
                failures = F.count(F.when(mine & ~_accepted(typed, c.values, c.quote), 1))
            else:
                raise ValueError(f"unknown check {c.check!r}")
            rows.append(_report_row(c.layer, c.table, col, c.check, failures))
    return grouped.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def observable(df: DataFrame, checks: Sequence[Check]) -> list[Check]:
    """The checks whose failures can be counted while the rows pass by: not_null,
    and accepted_values where the type bounds the number of distinct values (a
    decimal of up to four digits, a byte, a boolean)."""
    types = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))

    def bounded(t: T.DataType) -> bool:
        return isinstance(t, (T.ByteType, T.BooleanType)) or isinstance(t, T.DecimalType) and t.precision <= 4

    return [c for c in checks if c.check == NOT_NULL or c.check == ACCEPTED and bounded(types[c.column])]


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Callable[[], dict[Check, int]]]:
    """``df`` that counts the failures of ``checks`` while an action runs over it, and
    what gives the counts after the action, equal to ``run_checks`` on the rows.

    Put it last before a write: the tasks of a write count once, however often
    they are tried. Checks that are not ``observable`` raise.
    """
    if len(observable(df, checks)) != len(checks):
        raise ValueError("only not_null checks and accepted values of few distinct ones can be observed")
    if not checks:
        return df, dict
    counts = [
        (F.count_if(F.col(c.column).isNull()) if c.check == NOT_NULL
         else F.size(F.collect_set(F.when(~_accepted(F.col(c.column), c.values, c.quote), F.col(c.column))))).alias(str(i))
        for i, c in enumerate(checks)
    ]
    observation = Observation()
    return df.observe(observation, *counts), lambda: {c: int(observation.get[str(i)]) for i, c in enumerate(checks)}


def run_checks(
    tables: Mapping[tuple[str, str], DataFrame], checks: Iterable[Check] | None = None
) -> DataFrame:
    """Q4: one report row per declared check whose table is given:
    (layer, table_name, column_name, check_name, failures)."""
    checks = list(DECLARED if checks is None else checks)
    parts = []
    for (layer, table), df in tables.items():
        mine = [c for c in checks if c.layer == layer and c.table == table]
        part = check_table(df, mine)
        if part is not None:
            parts.append(part)
    if not parts:
        raise ValueError("no declared check matches the given tables")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failing(report: DataFrame) -> DataFrame:
    return report.where(F.col("failures") > 0)


LEDGER_NOT_NULL = (
    "ingestion_id", "source", "original_filename", "bucket", "object_key", "size_bytes",
    "status", "created_at", "updated_at",
)


def check_ledger(ledger: DataFrame) -> DataFrame:
    """Q5: the ledger's constraints as failure counts: NOT NULL columns, primary
    key on ingestion_id, unique (bucket, object_key), size_bytes >= 0.

    Two scans: counted by id with the NULL and size counts beside, and by key.
    """

    def row(check: str, label: str, failures: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check_name"), F.lit(label).alias("column_name"),
            F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
        )

    bad = {c: F.col(c).isNull() for c in LEDGER_NOT_NULL} | {"negative": F.col("size_bytes") < 0}
    by_id = ledger.groupBy(F.col("ingestion_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(is_bad).alias(name) for name, is_bad in bad.items()]
    )
    rows = [row(NOT_NULL, c, F.sum(c)) for c in LEDGER_NOT_NULL]
    rows.append(row("size_bytes_non_negative", "size_bytes", F.sum("negative")))
    rows.append(row("primary_key", "ingestion_id", F.count_if(F.col("id").isNotNull() & (F.col("n") > 1))))
    by_key = unique(ledger, ["bucket", "object_key"]).agg(
        F.array(row(UNIQUE, "bucket,object_key", F.count(F.lit(1)))).alias("r"))
    return by_id.agg(F.array(*rows).alias("r")).unionByName(by_key).select(F.inline("r"))


_R = specs.RATING_TEXT_VALUES_RATINGS
_V = specs.RATING_TEXT_VALUES_REVIEWS
_N = specs.RATING_NUMBER_VALUES

# The 43 declared checks (19 on bronze sources, 24 on gold marts),
# in the order they are declared.
DECLARED: tuple[Check, ...] = (
    Check("bronze", "ratings", "letterboxd_uri", NOT_NULL),
    Check("bronze", "ratings", "letterboxd_uri", UNIQUE),
    Check("bronze", "ratings", "name", NOT_NULL),
    Check("bronze", "ratings", "rating", NOT_NULL),
    Check("bronze", "ratings", "rating", ACCEPTED, _R, True),
    Check("bronze", "watched", "letterboxd_uri", NOT_NULL),
    Check("bronze", "watched", "letterboxd_uri", UNIQUE),
    Check("bronze", "watched", "name", NOT_NULL),
    Check("bronze", "watchlist", "letterboxd_uri", NOT_NULL),
    Check("bronze", "watchlist", "letterboxd_uri", UNIQUE),
    Check("bronze", "watchlist", "name", NOT_NULL),
    Check("bronze", "diary", "letterboxd_uri", NOT_NULL),
    Check("bronze", "diary", "name", NOT_NULL),
    Check("bronze", "diary", "watched_date", NOT_NULL),
    Check("bronze", "reviews", "letterboxd_uri", NOT_NULL),
    Check("bronze", "reviews", "name", NOT_NULL),
    Check("bronze", "reviews", "rating", ACCEPTED, _V, True),
    Check("bronze", "profile", "username", NOT_NULL),
    Check("bronze", "profile", "username", UNIQUE),
    Check("gold", "gold_top_rated_movies", "letterboxd_uri", NOT_NULL),
    Check("gold", "gold_top_rated_movies", "letterboxd_uri", UNIQUE),
    Check("gold", "gold_top_rated_movies", "name", NOT_NULL),
    Check("gold", "gold_top_rated_movies", "rating", NOT_NULL),
    Check("gold", "gold_top_rated_movies", "rating", ACCEPTED, _N, False),
    Check("gold", "gold_watchlist_by_year", "year", NOT_NULL),
    Check("gold", "gold_watchlist_by_year", "year", UNIQUE),
    Check("gold", "gold_watchlist_by_year", "watchlist_count", NOT_NULL),
    Check("gold", "gold_lowest_rated_movie", "letterboxd_uri", NOT_NULL),
    Check("gold", "gold_lowest_rated_movie", "letterboxd_uri", UNIQUE),
    Check("gold", "gold_lowest_rated_movie", "name", NOT_NULL),
    Check("gold", "gold_lowest_rated_movie", "rating", NOT_NULL),
    Check("gold", "gold_lowest_rated_movie", "rating", ACCEPTED, _N, False),
    Check("gold", "gold_best_movie_year", "year", NOT_NULL),
    Check("gold", "gold_best_movie_year", "year", UNIQUE),
    Check("gold", "gold_best_movie_year", "films_rated", NOT_NULL),
    Check("gold", "gold_best_movie_year", "avg_rating", NOT_NULL),
    Check("gold", "gold_recent_watch", "letterboxd_uri", NOT_NULL),
    Check("gold", "gold_recent_watch", "letterboxd_uri", UNIQUE),
    Check("gold", "gold_recent_watch", "watched_date", NOT_NULL),
    Check("gold", "gold_recent_watch", "name", NOT_NULL),
    Check("gold", "gold_watch_activity", "watch_month", NOT_NULL),
    Check("gold", "gold_watch_activity", "watch_month", UNIQUE),
    Check("gold", "gold_watch_activity", "films_watched", NOT_NULL),
)
