"""Bronze: CSV exports to all-text tables.

The CSV scan runs on executors, a task for each chunk of a file; only the chosen
file paths, the header rows and a few bytes for each chunk reach the driver. Each load is one job that writes a partition of its own,
so it can be run again after a failure at any point.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse import specs
from reelhouse.functions.text import na_literals, na_to_null
from reelhouse.plans import catalog
from reelhouse.sources import files, raw

log = logging.getLogger(__name__)

EXTRA = "_extra"
PARALLEL = 6  # independent small jobs started side by side

# The export dialect (header row, comma, double quotes doubled
# inside quoted fields, newlines allowed inside quotes, UTF-8).
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "inferSchema": "false",
}


def header_names(fields: Sequence[str]) -> list[str]:
    """B1: column names of a header, as Spark's own reader gives them: blank ones
    and those that differ in case alone get their position."""
    lower = [f.lower() for f in fields]
    return [f"_c{i}" if not f else f"{f}{i}" if lower.count(f.lower()) > 1 else f for i, f in enumerate(fields)]


def read_export(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True,
                chunk: int | None = None) -> DataFrame:
    """B1: one or more exports of the same dataset as all-text columns.

    A file is cut into chunks of ``chunk`` bytes at any place, also inside quoted
    fields (``sources.files``); a chunk's records go to Spark's own CSV parser.
    Line ends inside quotes stay as they are. A sentinel column is parsed besides
    the header's: a row with more fields than the header fills it, and the job
    then stops with an error instead of cutting the row silently; a short row is
    padded with NULL. Paths are names, not patterns. Files with different headers
    are read apart and put together by column name; a column that one of them
    lacks is NULL there.

    ``multi_line=False`` leaves the cutting to Spark's CSV source, for files in
    which no quoted field holds a newline; its listing leaves out names that
    start with ``_`` or ``.``. Paths that Arrow cannot open (``files.can_open``)
    are read by that source too, whole files to a task if ``multi_line``.
    """
    paths = [files.qualified(spark, p) for p in ([paths] if isinstance(paths, str) else paths)]
    if not all(files.can_open(p) for p in paths):
        parts = [_scanned(spark, [p], _spark_header(spark, p, multi_line), multi_line) for p in paths]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    by_header: dict[tuple[str, ...], list[files.Head]] = {}
    with ThreadPoolExecutor(PARALLEL) as pool:
        for head in pool.map(files.read_head, paths):
            by_header.setdefault(tuple(header_names(head.fields)), []).append(head)
    if multi_line:
        parts = [_parsed(files.csv_records(spark, heads, chunk), cols) for cols, heads in by_header.items()]
    else:
        parts = [_scanned(spark, [h.path for h in heads], cols, False) for cols, heads in by_header.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _no_more_fields(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    guard = F.when(
        F.col(EXTRA).isNotNull(),
        F.raise_error(F.lit("CSV row has more fields than the header")),
    ).otherwise(F.lit(True))
    return df.where(guard).select(*[_quoted(c) for c in cols])


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _parsed(records: DataFrame, cols: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"{_quoted(c)} string" for c in [*cols, EXTRA])
    options = {k: v for k, v in CSV_OPTIONS.items() if k in ("sep", "quote", "escape")}
    row = F.from_csv(F.col("record").cast("string"), schema, {**options, "mode": "PERMISSIVE"})
    return _no_more_fields(records.select(row.alias("row")).select("row.*"), cols)


def literal_path(path: str) -> str:
    """``path`` with the characters escaped that file sources take for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _spark_header(spark: SparkSession, path: str, multi_line: bool) -> list[str]:
    return spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower()).csv(literal_path(path)).columns


def _scanned(spark: SparkSession, paths: Sequence[str], cols: Sequence[str], multi_line: bool) -> DataFrame:
    """Spark's CSV source on files of one header."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*cols, EXTRA]])
    reader = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower(), mode="PERMISSIVE", enforceSchema="true")
    return _no_more_fields(reader.schema(schema).csv([literal_path(p) for p in paths]), cols)


def require_columns(df: DataFrame, dataset: str) -> DataFrame:
    """Every header of the dataset's rename map must be present (case-sensitive)."""
    found = list(df.columns)
    missing = [c for c in specs.spec(dataset) if c not in found]
    if missing:
        raise ValueError(
            f"The {dataset.lower()} export lacks the columns {missing}; its header is {found}"
        )
    return df


def rename(df: DataFrame, dataset: str) -> DataFrame:
    """Rename the mapped headers; other columns keep their CSV names."""
    return df.withColumnsRenamed(specs.spec(dataset))


def na_to_null_all(df: DataFrame) -> DataFrame:
    """The NA words become NULL in every column."""
    words = na_literals()
    return df.select(*[na_to_null(F.col(c), words).alias(c) for c in df.columns])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text; NULL stays NULL."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def to_bronze(df: DataFrame, dataset: str, na_words: bool = True,
              numeric_text: str = "raw") -> DataFrame:
    """B3-B6 (and B12 on request) on a parsed export."""
    out = rename(require_columns(df, dataset), dataset)
    if na_words:
        out = na_to_null_all(out)
    out = as_text(out)
    if numeric_text == "inferred":
        out = inferred_numeric_text(out)
    elif numeric_text != "raw":
        raise ValueError("numeric_text must be 'raw' or 'inferred'")
    return out


_INT = r"^[+-]?\d+\z"
_NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
_BOOL = ("True", "TRUE", "true", "False", "FALSE", "false")


def float_text(value: Column) -> Column:
    """A double in the layout of Python's ``repr``: plain digits with at least
    one decimal from 1e-4 up to below 1e16, else an exponent (``1.5e-05``)."""
    size = F.abs(value)
    java = value.cast("string")  # plain or 1.2345678E7
    digits = F.regexp_replace(java.try_cast("decimal(38,21)").cast("string"), r"0+\z", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0\z", "")
    power = F.substring_index(java, "E", -1).try_cast("int")
    exponent = F.concat(
        mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"),
    )
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(size == 0, java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(size == float("inf"), F.when(value < 0, F.lit("-inf")).otherwise(F.lit("inf")))
        .otherwise(exponent)
    )


def inferred_numeric_text(df: DataFrame) -> DataFrame:
    """Re-print numeric columns the way a type-inferring CSV reader would.

    A column whose non-NULL values are all integers and that has no NULL is
    printed as integers (``007`` -> ``7``); one whose values are all numbers,
    with a NULL, a fraction or an exponent, is printed as floats (``2019`` ->
    ``2019.0``, ``1e5`` -> ``100000.0``); one of true/false words as ``True``
    and ``False``. Integers of which one does not fit 64 bits, and all other
    columns, keep their text. One aggregate row of flags per column decides.
    """
    flags = []
    for c in df.columns:
        v = F.col(c)
        flags += [
            F.count(F.when(v.isNotNull() & ~v.rlike(_INT), 1)).alias(f"{c}__notint"),
            F.count(F.when(v.isNotNull() & ~v.rlike(_NUM), 1)).alias(f"{c}__notnum"),
            F.count(F.when(v.isNotNull() & ~v.isin(*_BOOL), 1)).alias(f"{c}__notbool"),
            F.count(F.when(v.rlike(_INT) & ~_fits_64(v), 1)).alias(f"{c}__wide"),
            F.count(F.when(v.isNull(), 1)).alias(f"{c}__null"),
            F.count(v).alias(f"{c}__n"),
        ]
    row = df.agg(*flags).first()
    out = []
    for c in df.columns:
        v = F.col(c)
        whole = row[f"{c}__notint"] == 0
        if row[f"{c}__n"] > 0 and row[f"{c}__notbool"] == 0:
            out.append(F.initcap(F.lower(v)).alias(c))
        elif row[f"{c}__n"] == 0 or row[f"{c}__notnum"] > 0 or (whole and row[f"{c}__wide"] > 0):
            out.append(v)
        elif whole and row[f"{c}__null"] == 0:
            out.append(v.cast("decimal(38,0)").cast("string").alias(c))
        else:
            out.append(float_text(v.cast("double")).alias(c))
    return df.select(*out)


def _fits_64(v: Column) -> Column:
    n = v.try_cast("decimal(38,0)")
    return n.isNotNull() & (n >= F.lit(Decimal(-(2**63)))) & (n < F.lit(Decimal(2**64)))


def bronze_table_name(dataset: str, layer: str = "bronze") -> str:
    specs.spec(dataset)
    return f"{layer}.{dataset.lower()}"


def append_bronze(df: DataFrame, dataset: str, layer: str = "bronze", load_id: str | None = None) -> bool:
    """Create the table on first use, then add the rows as one load; no
    rows -> warn, skip.

    Each load is a partition named by ``load_id``, which is new for each call
    unless given: loading a file again adds its rows again, as in the original;
    the same id again replaces what an unfinished attempt left. The table's
    columns are fixed by the first load: a later file with another extra column
    fails, one that lacks a column gets NULL there.
    """
    name = bronze_table_name(dataset, layer)
    if df.isEmpty():
        log.warning("Nothing appended to %s: the export has no rows", name)
        return False
    catalog.append_table(df, layer, dataset.lower(), load_id=load_id or uuid.uuid4().hex)
    return True


def read_files(spark: SparkSession, paths: str | Sequence[str], dataset: str,
               multi_line: bool = True, **opts) -> DataFrame:
    """B1-B6 (B12): exports of one dataset as bronze-shaped rows, not yet stored."""
    return to_bronze(read_export(spark, paths, multi_line), dataset, **opts)


def load_files(spark: SparkSession, paths: str | Sequence[str], dataset: str,
               layer: str = "bronze", multi_line: bool = True, load_id: str | None = None, **opts) -> bool:
    """B10 body: parse, check, rename, NA words, append. Many files of one
    dataset load in one job."""
    return append_bronze(read_files(spark, paths, dataset, multi_line, **opts), dataset, layer, load_id)


def load_latest(spark: SparkSession, raw_prefix: str, dataset: str, layer: str = "bronze",
                **opts) -> str:
    """Load the newest raw file of ``dataset``; returns its path. ``opts``
    go to ``load_files``, a ``load_id`` among them."""
    listing = raw.list_raw(spark, raw_prefix)
    key = raw.latest_key(raw.latest_object(listing, dataset), f"dataset '{dataset.lower()}'")
    load_files(spark, key, dataset, layer, **opts)
    return key


def load_all(spark: SparkSession, raw_prefix: str, datasets: Sequence[str] | None = None,
             layer: str = "bronze", **opts) -> dict[str, str]:
    """The newest file of every dataset found (or of ``datasets``).

    One listing job picks all newest files at once (at most six paths come back
    to the driver); the datasets' load jobs then run side by side, with one
    ``load_id`` for all if it is among ``opts``.
    """
    listing = raw.list_raw(spark, raw_prefix)
    latest = {r["dataset"]: r["path"] for r in raw.latest_objects(listing).collect()}
    wanted = sorted(latest) if datasets is None else [d.lower() for d in datasets]
    if not wanted:
        raise FileNotFoundError(f"No export files for any supported dataset under {raw_prefix}")
    absent = [ds for ds in wanted if ds not in latest]
    if absent:
        raise FileNotFoundError(f"No raw file of {absent} under {raw_prefix}")
    catalog.ensure_layers(spark, (layer,))
    with ThreadPoolExecutor(PARALLEL) as pool:
        jobs = [pool.submit(load_files, spark, latest[ds], ds, layer, **opts) for ds in wanted]
    for job in jobs:  # all have ended; the first failure is raised
        job.result()
    return {ds: latest[ds] for ds in wanted}


def headers_frame(df: DataFrame, dataset: str) -> DataFrame:
    """The inverse of ``rename``: bronze columns back to CSV header names."""
    back = {v: k for k, v in specs.spec(dataset).items()}
    return df.withColumnsRenamed(back)
