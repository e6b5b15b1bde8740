"""Gold marts: one statement each, over a silver DataFrame or as a view's text.

A mart is SQL with a place for its silver input. A builder runs it over a given
DataFrame (``spark.sql`` takes one by name); ``plans/views.py`` puts a table's name
there. Top-k marts become TakeOrderedAndProject (per-task top-k, no full sort);
the grouped marts are partial + final hash aggregates, so only one row per key and
map task crosses the shuffle however skewed the years or months are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.text import mean_2dp_sql
from reelhouse.operators.order import top_k


@dataclass(frozen=True)
class Mart:
    source: str  # silver dataset
    select: str  # {src}: its rows; {min_rows}: a parameter
    order: str  # total, with the warehouse's null order (desc = NULLs first, asc = NULLs last)
    limit: int | None = None
    min_rows: int | None = None

    def sql(self, src: str, ordered: bool = True, limit: int | None = None, min_rows: int | None = None) -> str:
        """The mart's text. A stored table does not keep row order anyway: callers
        that only count or check the rows of a mart without a limit may leave the final sort."""
        text = self.select.format(src=src, min_rows=self.min_rows if min_rows is None else int(min_rows))
        limit = self.limit if limit is None else int(limit)
        if ordered or limit is not None:
            text += f" ORDER BY {self.order}"
        return text if limit is None else f"{text} LIMIT {limit}"

    def rows(self, silver: DataFrame, **options) -> DataFrame:
        """The mart over a DataFrame of its silver columns."""
        return silver.sparkSession.sql(self.sql("{src}", **options), src=silver)


_FILMS = "SELECT name, year, rating, letterboxd_uri FROM {src} WHERE rating IS NOT NULL"

MARTS = {
    "gold_top_rated_movies": Mart(
        "ratings", _FILMS,
        "rating DESC NULLS FIRST, year DESC NULLS FIRST, name ASC NULLS LAST, letterboxd_uri ASC NULLS LAST", limit=10),
    "gold_lowest_rated_movie": Mart(
        "ratings", _FILMS,
        "rating ASC NULLS LAST, year DESC NULLS FIRST, name ASC NULLS LAST, letterboxd_uri ASC NULLS LAST", limit=1),
    "gold_best_movie_year": Mart(
        "ratings",
        f"SELECT year, COUNT(*) AS films_rated, {mean_2dp_sql('rating')} AS avg_rating FROM {{src}} "
        "WHERE rating IS NOT NULL AND year IS NOT NULL GROUP BY year HAVING COUNT(*) >= {min_rows}",
        "avg_rating DESC NULLS FIRST, films_rated DESC NULLS FIRST, year ASC NULLS LAST", min_rows=3),
    "gold_recent_watch": Mart(
        "diary", "SELECT name, year, watched_date, rating, rewatch, letterboxd_uri FROM {src} WHERE watched_date IS NOT NULL",
        "watched_date DESC NULLS FIRST, name ASC NULLS LAST, letterboxd_uri ASC NULLS LAST, year ASC NULLS LAST, "
        "rating ASC NULLS LAST, rewatch ASC NULLS LAST", limit=1),
    "gold_watch_activity": Mart(
        "diary", "SELECT trunc(watched_date, 'MM') AS watch_month, COUNT(*) AS films_watched FROM {src} "
        "WHERE watched_date IS NOT NULL GROUP BY trunc(watched_date, 'MM')",
        "watch_month ASC NULLS LAST"),
    "gold_watchlist_by_year": Mart(
        "watchlist", "SELECT year, COUNT(*) AS watchlist_count FROM {src} WHERE year IS NOT NULL GROUP BY year",
        "year ASC NULLS LAST"),
}


def gold_top_rated_movies(silver_ratings: DataFrame, k: int = 10) -> DataFrame:
    """G1: the k best rated films; NULL years sort before dated films of a rating."""
    return MARTS["gold_top_rated_movies"].rows(silver_ratings, limit=k)


def gold_lowest_rated_movie(silver_ratings: DataFrame) -> DataFrame:
    """The single lowest rated film."""
    return MARTS["gold_lowest_rated_movie"].rows(silver_ratings)


def gold_best_movie_year(silver_ratings: DataFrame, min_rows: int = 3, ordered: bool = True) -> DataFrame:
    """Films rated and exact mean rating (2 places) per year with >= min_rows films."""
    return MARTS["gold_best_movie_year"].rows(silver_ratings, ordered=ordered, min_rows=min_rows)


def having_min_rows(grouped: DataFrame, count_col: str, min_rows: int) -> DataFrame:
    """A5: HAVING count >= min_rows (a filter after the aggregate)."""
    return grouped.where(F.col(count_col) >= min_rows)


def gold_recent_watch(silver_diary: DataFrame) -> DataFrame:
    """The most recently watched diary entry."""
    return MARTS["gold_recent_watch"].rows(silver_diary)


def gold_watch_activity(silver_diary: DataFrame, ordered: bool = True) -> DataFrame:
    """Diary entries per month start."""
    return MARTS["gold_watch_activity"].rows(silver_diary, ordered=ordered)


def gold_watchlist_by_year(silver_watchlist: DataFrame, ordered: bool = True) -> DataFrame:
    """Watchlist films per release year."""
    return MARTS["gold_watchlist_by_year"].rows(silver_watchlist, ordered=ordered)


def latest_periods(gold: DataFrame, period_col: str, n: int = 12) -> DataFrame:
    """The latest n periods of a monthly or yearly mart, newest first."""
    return top_k(gold, [f"{period_col} desc"], n)


UNORDERED_OK = {name for name, mart in MARTS.items() if mart.limit is None}

# Mart name -> (silver input, builder).
GOLD_BUILDERS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    name: (MARTS[name].source, builder) for name, builder in {
        "gold_top_rated_movies": gold_top_rated_movies,
        "gold_lowest_rated_movie": gold_lowest_rated_movie,
        "gold_best_movie_year": gold_best_movie_year,
        "gold_recent_watch": gold_recent_watch,
        "gold_watch_activity": gold_watch_activity,
        "gold_watchlist_by_year": gold_watchlist_by_year,
    }.items()
}
