"""Dataset specifications.

Everything in this module is a fixed value: it has to equal what the film-log
exports and the layered warehouse use, so it is written out plainly rather than
derived.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# CSV header -> bronze column, per dataset (bronze renames).
# ---------------------------------------------------------------------------
RENAME_MAPS: dict[str, dict[str, str]] = {
    "ratings": {
        "Date": "list_date",
        "Name": "name",
        "Year": "year",
        "Letterboxd URI": "letterboxd_uri",
        "Rating": "rating",
    },
    "watched": {
        "Date": "list_date",
        "Name": "name",
        "Year": "year",
        "Letterboxd URI": "letterboxd_uri",
    },
    "watchlist": {
        "Date": "list_date",
        "Name": "name",
        "Year": "year",
        "Letterboxd URI": "letterboxd_uri",
    },
    "reviews": {
        "Date": "list_date",
        "Name": "name",
        "Year": "year",
        "Letterboxd URI": "letterboxd_uri",
        "Rating": "rating",
        "Rewatch": "rewatch",
        "Review": "review",
        "Tags": "tags",
        "Watched Date": "watched_date",
    },
    "diary": {
        "Date": "list_date",
        "Name": "name",
        "Year": "year",
        "Letterboxd URI": "letterboxd_uri",
        "Rating": "rating",
        "Rewatch": "rewatch",
        "Tags": "tags",
        "Watched Date": "watched_date",
    },
    "profile": {
        "Date Joined": "date_joined",
        "Username": "username",
        "Given Name": "given_name",
        "Family Name": "family_name",
        "Email Address": "email_address",
        "Location": "location",
        "Website": "website",
        "Bio": "bio",
        "Pronoun": "pronoun",
        "Favorite Films": "favorite_films",
    },
}

# Fixed value: the six datasets, sorted.
DATASETS: tuple[str, ...] = ("diary", "profile", "ratings", "reviews", "watched", "watchlist")

# Fixed value: separators allowed between a free prefix and the dataset name in
# an export file name ("my_ratings.csv", "x-ratings.csv", "a ratings.csv").
NAME_SEPARATORS: tuple[str, ...] = ("_", "-", " ")

# Fixed value: strings the CSV reader of the original loader turns into NULL
# (exact, case-sensitive match on the raw field).
NA_WORDS: tuple[str, ...] = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Boolean tokens of the rewatch column (compared lower-cased).
TRUE_TOKENS: tuple[str, ...] = ("yes", "y", "true", "t", "1")
FALSE_TOKENS: tuple[str, ...] = ("no", "n", "false", "f", "0")

# Regex guards. Java's `$` also matches before a final newline,
# so the guards end in `\z`; `\d` is ASCII-only in Java.
DATE_GUARD = r"^\d{4}-\d{2}-\d{2}\z"
YEAR_GUARD = r"^\d{4}\z"
RATING_GUARD = r"^\d+(\.\d+)?\z"

# Raw-zone and ledger constants.
RAW_PREFIX = "letterboxd/"
LEDGER_SOURCE = "letterboxd_csv"
DEFAULT_CONTENT_TYPE = "text/csv"
UPLOADED = "uploaded"
DEFAULT_BUCKET = "raw"

# Layer (database) names.
LAYERS: tuple[str, ...] = ("bronze", "silver", "gold")

# Accepted rating values of the declared checks.
RATING_TEXT_VALUES_RATINGS: tuple[str, ...] = (
    "0.5", "1.0", "1.5", "2.0", "2.5", "3.0", "3.5", "4.0", "4.5", "5.0",
)
RATING_TEXT_VALUES_REVIEWS: tuple[str, ...] = (
    "0.5", "1.0", "1.5", "2.0", "2.5", "3.0", "3.5", "4.0", "4.5", "5",
)
RATING_NUMBER_VALUES: tuple[Decimal, ...] = tuple(
    Decimal(v) for v in ("0.5", "1.0", "1.5", "2.0", "2.5", "3.0", "3.5", "4.0", "4.5", "5.0")
)

# Typed shapes.
RATING_TYPE = T.DecimalType(3, 1)


def bronze_schema(dataset: str) -> T.StructType:
    """All-text bronze schema of a dataset (required columns only)."""
    return T.StructType(
        [T.StructField(c, T.StringType(), True) for c in spec(dataset).values()]
    )


def spec(dataset: str) -> dict[str, str]:
    """Rename map of a dataset; unknown names raise and list the supported ones."""
    key = dataset.lower()
    if key not in RENAME_MAPS:
        raise ValueError(
            f"{key!r} is not a dataset; the datasets are {', '.join(sorted(RENAME_MAPS))}"
        )
    return RENAME_MAPS[key]


SILVER_COLUMNS: dict[str, tuple[str, ...]] = {
    "ratings": ("list_date", "name", "year", "letterboxd_uri", "rating"),
    "watched": ("list_date", "name", "year", "letterboxd_uri"),
    "watchlist": ("list_date", "name", "year", "letterboxd_uri"),
    "diary": ("list_date", "name", "year", "letterboxd_uri", "rating", "rewatch", "tags",
              "watched_date"),
    "reviews": ("list_date", "name", "year", "letterboxd_uri", "rating", "rewatch", "review",
                "tags", "watched_date"),
    "profile": ("date_joined", "username", "given_name", "family_name", "email_address",
                "location", "website", "bio", "pronoun", "favorite_films"),
}

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("ingestion_id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("original_filename", T.StringType(), False),
        T.StructField("bucket", T.StringType(), False),
        T.StructField("object_key", T.StringType(), False),
        T.StructField("size_bytes", T.LongType(), False),
        T.StructField("content_type", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)
