"""Bronze-shaped stand-in inputs derived from the driver's Parquet tables.

There are no real film-log exports to test against, so each bronze dataset is
derived, row for row, from one of the driver tables: every input row gives one
bronze row (the diary stand-in takes ``orders`` twice, as a file loaded twice
into an append-only bronze table does). Value rules mix in the edge cases the
silver layer must handle: blank and space-only values, malformed dates, years
and ratings, NA words, NULL keys and ties. The same rules are written in SQL for
the DuckDB oracle (``reelhouse.oracle``); both sides must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import specs
from reelhouse.sources.tables import read_parquet

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _d(c: Column) -> Column:
    """ISO date text of a timestamp."""
    return F.date_format(c, "yyyy-MM-dd")


def _lit(v: str) -> Column:
    return F.lit(v)


def ratings(spark: SparkSession, sf_dir: str, extra: bool = False) -> DataFrame:
    """bronze.ratings from lineitem (one row per line item); ``extra`` adds an
    unmapped export column ``Note`` (the return flag)."""
    li = table(spark, sf_dir, "lineitem")
    pk = F.col("l_partkey")
    year = _s(1950 + pk % 75)
    return li.select(
        F.when(F.col("l_linenumber") == 7, _lit("  "))
        .when(F.col("l_linenumber") == 6, F.concat(_d(F.col("l_shipdate")), _lit("T00")))
        .otherwise(F.concat(_lit(" "), _d(F.col("l_shipdate")), _lit(" ")))
        .alias("list_date"),
        F.when(pk % 97 == 0, _lit("")).otherwise(F.concat(_lit(" Film "), _s(pk))).alias("name"),
        F.when(F.col("l_quantity") == 13, F.concat(year, _lit(".0")))
        .when(F.col("l_quantity") == 14, _lit(""))
        .otherwise(year)
        .alias("year"),
        F.when(pk % 501 == 0, _lit(" "))
        .otherwise(F.concat(_lit("https://uri.test/f/"), _s(pk)))
        .alias("letterboxd_uri"),
        F.when(F.col("l_discount") > 0.095, _lit("n/a"))
        .when(F.col("l_discount") < 0.005, _lit(""))
        .otherwise(
            F.concat(
                _s(F.round(F.col("l_discount") * 100).cast("int")),
                _lit("."),
                _s(F.col("l_linenumber") % 10),
                _lit("5"),
            )
        )
        .alias("rating"),
        *([F.col("l_returnflag").alias("Note")] if extra else []),
    )


def diary(spark: SparkSession, sf_dir: str, passes: tuple[int, ...] = (1, 2)) -> DataFrame:
    """bronze.diary from orders, loaded twice (pass 2 lists a day later);
    ``passes`` picks the loads, e.g. ``(2,)`` for the second one alone."""
    o = table(spark, sf_dir, "orders")
    loads = [o.withColumn("p", F.lit(p)) for p in passes]
    twice = loads[0]
    for more in loads[1:]:
        twice = twice.unionByName(more)
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return twice.select(
        F.when(ok % 10 == 0, _lit(""))
        .when(ok % 10 == 1, _lit("soon"))
        .when(F.col("p") == 2, _d(F.date_add(F.col("o_orderdate"), 1)))
        .otherwise(_d(F.col("o_orderdate")))
        .alias("list_date"),
        F.when(ck % 89 == 0, _lit(" ")).otherwise(F.concat(_lit("Film "), _s(ck % 700))).alias("name"),
        F.when(ok % 9 == 0, _lit("19x9")).otherwise(_s(1950 + ck % 70)).alias("year"),
        F.when(ck % 251 == 0, _lit("   "))
        .otherwise(F.concat(_lit(" https://uri.test/d/"), _s(ck % 700)))
        .alias("letterboxd_uri"),
        F.when(ok % 6 == 0, _lit("")).otherwise(F.concat(_s(ok % 5), _lit(".5"))).alias("rating"),
        F.when(F.col("o_orderstatus") == "F", _lit("Yes"))
        .when(F.col("o_orderstatus") == "O", _lit(" no "))
        .when(ok % 2 == 0, _lit("T"))
        .when(ok % 3 == 0, _lit(""))
        .otherwise(_lit("maybe"))
        .alias("rewatch"),
        F.col("o_orderpriority").alias("tags"),
        F.when(ok % 12 == 0, _lit("2024/01/01")).otherwise(_d(F.col("o_orderdate"))).alias("watched_date"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.reviews from events."""
    e = table(spark, sf_dir, "events")
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    return e.select(
        F.when(eid % 10 == 0, _lit("")).when(eid % 10 == 1, _lit("soon")).otherwise(_d(F.col("ts"))).alias("list_date"),
        F.when(eid % 83 == 0, _lit("")).otherwise(F.concat(_lit("Film "), _s(uid))).alias("name"),
        F.when(eid % 9 == 0, _lit("2019.0")).otherwise(_s(1950 + uid % 70)).alias("year"),
        F.when(uid % 50 == 0, _lit("  "))
        .otherwise(F.concat(_lit("https://uri.test/r/"), _s(uid)))
        .alias("letterboxd_uri"),
        F.when(eid % 6 == 0, _lit("-1"))
        .when(eid % 6 == 1, _lit("5"))
        .otherwise(F.concat(_s(eid % 5), _lit(".5")))
        .alias("rating"),
        F.when(et == "click", _lit("Yes"))
        .when(et == "view", _lit(" FALSE "))
        .when(et == "purchase", _lit("1"))
        .when(et == "signup", _lit("N"))
        .otherwise(_lit(""))
        .alias("rewatch"),
        F.concat(_lit(" "), et, _lit(" ")).alias("review"),
        F.col("props").alias("tags"),
        F.when(eid % 12 == 0, _lit("")).otherwise(_d(F.col("ts"))).alias("watched_date"),
    )


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.watchlist from orders."""
    o = table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.when(ok % 4 == 0, _lit(""))
        .when(ok % 4 == 1, _lit("2024-1-1"))
        .otherwise(_d(F.col("o_orderdate")))
        .alias("list_date"),
        F.concat(_lit("Film "), _s(ck), _lit(" ")).alias("name"),
        F.when(ok % 7 == 0, _lit("n.d.")).otherwise(_s(1950 + ck % 70)).alias("year"),
        F.when(ck % 401 == 0, _lit(""))
        .otherwise(F.concat(_lit("https://uri.test/w/"), _s(ck)))
        .alias("letterboxd_uri"),
    )


def watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.watched: the watchlist input (the NULL order of the dedupe differs)."""
    return watchlist(spark, sf_dir)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.profile from customer."""
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    return c.select(
        F.when(ck % 5 == 0, _lit(""))
        .when(ck % 5 == 1, _lit("1 Jan 2024"))
        .otherwise(
            F.concat(
                _lit("20"),
                F.lpad(_s(ck % 20), 2, "0"),
                _lit("-0"),
                _s(1 + ck % 9),
                _lit("-15"),
            )
        )
        .alias("date_joined"),
        F.when(ck % 301 == 0, _lit(" ")).otherwise(F.concat(_lit("user"), _s(ck % 400))).alias("username"),
        F.col("c_mktsegment").alias("given_name"),
        _lit("").alias("family_name"),
        F.concat(F.col("c_name"), _lit("@mail.test")).alias("email_address"),
        F.concat(_lit(" nation "), _s(F.col("c_nationkey"))).alias("location"),
        _lit("  ").alias("website"),
        F.col("c_name").alias("bio"),
        F.when(ck % 2 == 0, _lit("they")).otherwise(_lit("")).alias("pronoun"),
        _s(ck).alias("favorite_films"),
    )


BRONZE = {
    "ratings": ratings,
    "watched": watched,
    "watchlist": watchlist,
    "diary": diary,
    "reviews": reviews,
    "profile": profile,
}


# --- raw zone stand-ins -------------------------------------------------------

# Fixed values of the stand-in file names: separator, dataset spelling and
# extension are picked by doc_id so that some names match a dataset and some
# do not (wrong extension, no separator, a longer word ending in a dataset).
NAME_SEPS = ["_", "-", " ", "", "."]
NAME_DATASETS = ["diary", "Profile", "RATINGS", "reviews", "Watched", "watchlist", "unwatched"]
NAME_EXTS = [".csv", ".CSV", ".csv", ".txt", ".csv", "", ".Csv", ".csv.bak", ".csv", ".tsv", ".csv"]
LISTING_DATASETS = ["diary", "profile", "ratings", "reviews", "watched", "watchlist", "notes"]


def _pick(options: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (idx % len(options) + 1).cast("int"))


def export_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploaded files from documents: path ``in/<source><sep><dataset><ext>``,
    bytes = the UTF-8 text, length = byte count."""
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    path = F.concat(
        _lit("in/"), F.col("source"), _pick(NAME_SEPS, did), _pick(NAME_DATASETS, did),
        _pick(NAME_EXTS, did),
    )
    content = F.encode(F.col("text"), "UTF-8")
    return d.select(
        did.alias("doc_id"),
        path.alias("path"),
        F.element_at(F.split(path, "/"), -1).alias("name"),
        F.octet_length(content).cast("long").alias("length"),
        content.alias("content"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw-zone listing from orders: one object per order under
    ``<raw prefix><orderkey % 500>/<orderkey>_<dataset>.csv``, modified at the order date."""
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    path = F.concat(
        _lit(specs.RAW_PREFIX), _s(ok % 500), _lit("/"), _s(ok), _lit("_"),
        _pick(LISTING_DATASETS, ok), _lit(".csv"),
    )
    return o.select(
        path.alias("path"),
        F.col("o_orderdate").alias("modificationTime"),
        F.col("o_totalprice").cast("long").alias("length"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion ledger rows from orders: a customer's repeated dataset reuses an
    object key; a customer's repeated priority reuses an id; small orders get a
    negative size."""
    from reelhouse.sources.raw import uuid_from  # local: avoid an import cycle

    o = table(spark, sf_dir, "orders")
    ds = _pick(LISTING_DATASETS[:6], F.col("o_orderkey"))
    return o.select(
        uuid_from(_s(F.col("o_custkey")), F.col("o_orderpriority")).alias("ingestion_id"),
        _lit(specs.LEDGER_SOURCE).alias("source"),
        F.concat(ds, _lit(".csv")).alias("original_filename"),
        _lit(specs.DEFAULT_BUCKET).alias("bucket"),
        F.concat(_lit(specs.RAW_PREFIX), _s(F.col("o_custkey")), _lit("/"), ds, _lit(".csv")).alias("object_key"),
        (F.col("o_totalprice").cast("long") - 50000).alias("size_bytes"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(_lit("text/csv"))
        .alias("content_type"),
        _lit(specs.UPLOADED).alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderstatus"),
    )
