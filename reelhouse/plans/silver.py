"""Silver models: clean -> guard-cast -> keep first per key -> filter -> project.

Each builder takes a bronze-shaped DataFrame (all text) and returns the typed
silver DataFrame; nothing is executed until an action or a write.
``on_bad="fail"`` stops the job on a value that passes a guard but not the cast
(``2024-13-45``, ``100``); ``on_bad="null"`` turns it into NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.text import (
    blank_to_null,
    text_to_bool,
    text_to_date,
    text_to_rating,
    text_to_year,
)
from reelhouse.operators.dedupe import keep_first


# Columns whose guard or token map makes a blank text NULL by itself.
GUARDED = ("list_date", "year", "rating", "rewatch", "watched_date", "date_joined")


def _clean(bronze: DataFrame, columns: list[str]) -> DataFrame:
    """A projection of its own: guards and casts read a cleaned value several
    times, and as one expression each of them would trim it again. A mart's filter on
    a typed column is pushed to the scan and evaluates all it reads there once more,
    so guarded columns are only trimmed."""
    return bronze.select(*[(F.trim(F.col(c).cast("string")) if c in GUARDED else blank_to_null(c)).alias(c) for c in columns])


def _film_typed(on_bad: str) -> list:
    return [
        text_to_date("list_date", on_bad).alias("list_date"),
        F.col("name"),
        text_to_year("year").alias("year"),
        F.col("letterboxd_uri"),
    ]


def typed_ratings(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    src = _clean(bronze, ["list_date", "name", "year", "letterboxd_uri", "rating"])
    return src.select(*_film_typed(on_bad), text_to_rating("rating", on_bad).alias("rating"))


def typed_watched(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    src = _clean(bronze, ["list_date", "name", "year", "letterboxd_uri"])
    return src.select(*_film_typed(on_bad))


def _diary_like(bronze: DataFrame, with_review: bool, on_bad: str) -> DataFrame:
    cols = ["list_date", "name", "year", "letterboxd_uri", "rating", "rewatch"]
    cols += ["review"] if with_review else []
    cols += ["tags", "watched_date"]
    src = _clean(bronze, cols)
    out = [
        *_film_typed(on_bad),
        text_to_rating("rating", on_bad).alias("rating"),
        text_to_bool("rewatch").alias("rewatch"),
    ]
    if with_review:
        out.append(F.col("review"))
    out += [F.col("tags"), text_to_date("watched_date", on_bad).alias("watched_date")]
    return src.select(*out)


def typed_diary(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    return _diary_like(bronze, False, on_bad)


def typed_reviews(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    return _diary_like(bronze, True, on_bad)


PROFILE_TEXT = [
    "username",
    "given_name",
    "family_name",
    "email_address",
    "location",
    "website",
    "bio",
    "pronoun",
    "favorite_films",
]


def typed_profile(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    src = _clean(bronze, ["date_joined", *PROFILE_TEXT])
    return src.select(text_to_date("date_joined", on_bad).alias("date_joined"), *PROFILE_TEXT)


# Per dataset the typing step, the dedupe key (W1a-W1f), the
# order that picks the kept row (with the warehouse's null order), and the key
# column whose NULL rows are dropped after the dedupe (None: kept).
SILVER_SPECS = {
    "ratings": (typed_ratings, ["letterboxd_uri", "list_date", "rating"],
                ["letterboxd_uri asc"], None),
    "watched": (typed_watched, ["letterboxd_uri"], ["list_date desc nulls last"],
                "letterboxd_uri"),
    "watchlist": (typed_watched, ["letterboxd_uri"], ["list_date desc nulls first"], None),
    "diary": (typed_diary, ["letterboxd_uri", "watched_date", "rating"],
              ["list_date desc nulls last"], "letterboxd_uri"),
    "reviews": (typed_reviews, ["letterboxd_uri", "watched_date"],
                ["list_date desc nulls last"], "letterboxd_uri"),
    "profile": (typed_profile, ["username"], ["date_joined desc nulls last"], "username"),
}


def dedupe(bronze: DataFrame, dataset: str, on_bad: str = "fail") -> DataFrame:
    """Typed rows, first per key; NULL keys form a group and are kept."""
    typed_fn, key, order, _ = SILVER_SPECS[dataset]
    return keep_first(typed_fn(bronze, on_bad), key, order)


def build_silver(bronze: DataFrame, dataset: str, on_bad: str = "fail") -> DataFrame:
    """Dedupe, then drop NULL keys where the model does."""
    deduped = dedupe(bronze, dataset, on_bad)
    drop_null = SILVER_SPECS[dataset][3]
    return deduped.where(F.col(drop_null).isNotNull()) if drop_null else deduped


def fold(current: DataFrame, new_bronze: DataFrame, dataset: str, on_bad: str = "fail") -> DataFrame:
    """Silver of (old bronze + new bronze), given ``current`` = silver of the
    old bronze: equal to ``build_silver`` over all rows.

    Keep-first takes the minimum of a total order per key, which can be taken
    in steps; the NULL-key filter removes whole key groups, so it commutes.
    Only keys present in the new rows can change: the rest of ``current``
    passes through a NULL-safe anti join on the new keys (NULL keys form a
    group) and is not shuffled; AQE broadcasts the key side when its measured
    size allows.
    """
    fresh = build_silver(new_bronze, dataset, on_bad)
    key = SILVER_SPECS[dataset][1]
    order = SILVER_SPECS[dataset][2]
    keys = fresh.select(*[F.col(k).alias(f"__k_{k}") for k in key]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in key])
    untouched = current.join(keys, same, "left_anti")
    touched = current.join(keys, same, "left_semi")
    return untouched.unionByName(keep_first(touched.unionByName(fresh), key, order))


def silver_ratings(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """One row per (uri, list_date, rating); NULL-URI rows are kept."""
    return build_silver(bronze, "ratings", on_bad)


def silver_watched(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Latest list_date per URI (NULL dates lose); NULL URIs dropped."""
    return build_silver(bronze, "watched", on_bad)


def silver_watchlist(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """D3: per URI a row with a NULL list_date wins, else the latest; NULL URI kept."""
    return build_silver(bronze, "watchlist", on_bad)


def silver_diary(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Latest list_date per (uri, watched_date, rating); NULL URIs dropped."""
    return build_silver(bronze, "diary", on_bad)


def silver_reviews(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Latest list_date per (uri, watched_date); NULL URIs dropped."""
    return build_silver(bronze, "reviews", on_bad)


def silver_profile(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Latest date_joined per username; NULL usernames dropped."""
    return build_silver(bronze, "profile", on_bad)


SILVER_BUILDERS = {
    "ratings": silver_ratings,
    "watched": silver_watched,
    "watchlist": silver_watchlist,
    "diary": silver_diary,
    "reviews": silver_reviews,
    "profile": silver_profile,
}
