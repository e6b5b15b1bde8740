"""Scalar column functions of the silver layer.

Each function maps a Column to a Column with built-in Spark expressions only, so
it stays inside whole-stage codegen and runs the same on any cluster size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse import specs

ON_BAD = ("fail", "null")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """`nullif(trim(x::text), '')`: trims spaces only (not tabs or newlines)."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def na_literals() -> list[Column]:
    """The NA words as literal columns (build once, reuse across columns)."""
    return [F.lit(w) for w in specs.NA_WORDS]


def na_to_null(c: Column | str, words: list[Column] | None = None) -> Column:
    """NULL for the exact NA words of the original CSV reader; other values unchanged."""
    c = _col(c)
    return F.when(~c.isin(*(words if words is not None else specs.NA_WORDS)), c)


def _guarded_cast(c: Column, guard: str, to: str, on_bad: str, what: str) -> Column:
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}, got {on_bad!r}")
    cast = c.try_cast(to)
    if to == "date":  # the calendar has no year 0
        cast = F.when(~c.startswith("0000"), cast)
    if on_bad == "fail":
        # A value that passes the guard but does not fit the type stops the job,
        # whatever the session's ANSI setting is.
        cast = F.coalesce(
            cast,
            F.raise_error(F.concat(F.lit(f"invalid {what}: "), c)),
        )
    return F.when(c.rlike(guard), cast)


def text_to_date(c: Column | str, on_bad: str = "fail") -> Column:
    """Date when the text is `dddd-dd-dd`, else NULL."""
    return _guarded_cast(_col(c), specs.DATE_GUARD, "date", on_bad, "date")


def text_to_year(c: Column | str) -> Column:
    """Integer year when the text is exactly four ASCII digits, else NULL."""
    c = _col(c)
    return F.when(c.rlike(specs.YEAR_GUARD), c.cast("int"))


def text_to_rating(c: Column | str, on_bad: str = "fail") -> Column:
    """decimal(3,1) when the text is an unsigned decimal, else NULL (3.25 -> 3.3)."""
    return _guarded_cast(_col(c), specs.RATING_GUARD, "decimal(3,1)", on_bad, "rating")


def text_to_bool(c: Column | str) -> Column:
    """Token map to a three-valued boolean; unknown tokens and NULL give NULL."""
    low = F.lower(_col(c))
    return F.when(low.isin(*specs.TRUE_TOKENS), F.lit(True)).when(
        low.isin(*specs.FALSE_TOKENS), F.lit(False)
    )


def month_start(c: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(c), "MM")


def mean_2dp_sql(c: str) -> str:
    """Aggregate, as SQL text: mean of a decimal(3,1) column rounded half-up to 2 places, exactly.

    Averaging a decimal and then rounding rounds twice (the average is already cut
    to a few places), so the mean is computed in integer tenths:
    round(100 * s / (10 n)) = (20 s + n) div (2 n) for s = sum of tenths, n = count.
    Long arithmetic cannot overflow for any realistic row count, unlike a
    decimal sum whose precision is fixed. Ratings are never negative (the guard
    takes no sign), so half-up is the same as half away from zero.
    """
    hundredths = f"(20 * SUM(CAST({c} * 10 AS BIGINT)) + COUNT({c})) DIV (2 * COUNT({c}))"  # in longs, never through a double
    return f"CAST(CAST({hundredths} AS DECIMAL(20,0)) / 100 AS DECIMAL(5,2))"


def mean_2dp(c: str) -> Column:
    """``mean_2dp_sql`` of a column, given by its name."""
    return F.expr(mean_2dp_sql(f"`{c}`"))
