"""Layers as Spark databases, tables and views (K1-K6), and row counts."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse import specs
from reelhouse.operators.checks import Check, observable, observed
from reelhouse.session import checkpoint_dir


def layer_name(custom: str | None, default: str) -> str:
    """K4: a model's own layer name is used as given (no target prefix);
    without one, the default layer."""
    name = (custom or "").strip()
    return name if name else default


def ensure_layers(spark: SparkSession, layers=specs.LAYERS) -> None:
    """K5: create the layer databases when absent."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")


def list_layers(spark: SparkSession, layers=specs.LAYERS) -> DataFrame:
    """K6: the layer databases that exist, sorted."""
    found = spark.sql("SHOW DATABASES").select(F.col("namespace").alias("schema_name"))
    return found.where(F.col("schema_name").isin(*layers)).orderBy("schema_name")


class Saved(NamedTuple):
    table: str
    failures: dict[Check, int]  # of the checks that were counted while the table was written


def save_table(df: DataFrame, layer: str, name: str, fmt: str = "parquet", checks: Sequence[Check] = ()) -> Saved:
    """K1: full rebuild of ``layer.name``; returns its name, and the failures of
    those of ``checks`` that can be counted on the way (``checks.observable``; the
    stored rows are not scanned for them).

    The rows are written to a new folder beside the table's earlier versions,
    and the table is then pointed at it by one change of the catalog. A build
    that fails leaves the table as it was, a reader sees the old rows or the new
    ones, and ``df`` may read the table itself. If the columns differ from the
    table's, or a view has the name, the old entry is dropped and a new one made
    (two changes of the catalog, after the rows are written). The files of the
    version before stay, for readers that began on them, until the next rebuild.

    A written table also cuts the lineage: readers of the next layer start
    from these files, not from the plan that made them.
    """
    spark = df.sparkSession
    ensure_layers(spark, (layer,))
    full = f"`{layer}`.`{name}`"
    folder = f"{versions_folder(spark, layer, name)}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    watched, failures = observed(df, observable(df, checks))
    watched.write.format(fmt).save(folder)
    before = _described(spark, layer, name) if table_exists(spark, layer, name) else None
    if before is not None and _same_table(before, spark.table(f"{layer}.{name}").schema, fmt, df.schema):
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{_quoted(folder)}'")
    else:
        if before is not None:
            spark.sql(f"DROP {'VIEW' if before.get('Type') == 'VIEW' else 'TABLE'} {full}")
        spark.catalog.createTable(full, path=folder, source=fmt, schema=df.schema)
    spark.catalog.refreshTable(full)
    if before is not None and before.get("Location"):  # a view has none
        _forget_versions(spark, versions_folder(spark, layer, name), before["Location"])
    return Saved(f"{layer}.{name}", failures())


def versions_folder(spark: SparkSession, layer: str, name: str) -> str:
    """Where the versions of a rebuilt table lie: beside the layer's other tables."""
    return f"{spark.catalog.getDatabase(layer).locationUri.rstrip('/')}/{name}__versions"


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _described(spark: SparkSession, layer: str, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{layer}`.`{name}`").collect()}


def _same_table(described: dict[str, str], old: T.StructType, fmt: str, new: T.StructType) -> bool:
    """Whether it is an unpartitioned table of the format with these columns."""
    columns = [[(f.name, f.dataType) for f in schema.fields] for schema in (old, new)]
    return (columns[0] == columns[1] and described.get("Type") != "VIEW" and "# Partition Information" not in described
            and described.get("Provider", "").lower() == fmt.lower())


def _forget_versions(spark: SparkSession, folder: str, before: str) -> None:
    """Delete the versions older than ``before``, what failed builds left among
    them (names begin with the time)."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if path(before).getParent() is None or path(before).getParent().toUri().getPath() != path(folder).toUri().getPath():
        return  # the table lay elsewhere
    for n in sorted(f.getPath().getName() for f in fs.listStatus(path(folder))):
        if n < path(before).getName():
            fs.delete(path(f"{folder}/{n}"), True)


def save_view(spark: SparkSession, df: DataFrame, layer: str, name: str) -> str:
    """K2 for an arbitrary DataFrame: a temporary view named ``layer__name``
    (a persistent view needs SQL text; the gold marts have it, see
    ``plans/views.py``)."""
    view = f"{layer}__{name}"
    df.createOrReplaceTempView(view)
    return view


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back, so that
    several later steps read the same rows from files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The partition column that names the load which a row came with.
LOAD_ID = "load_id"


def append_table(df: DataFrame, layer: str, name: str, fmt: str = "parquet", load_id: str | None = None,
                 buckets: tuple[int, str] | None = None) -> str:
    """K3: append to ``layer.name``, creating it on first use.

    With ``load_id`` the rows become that partition of the table, and replace
    what an earlier attempt of the same load left there: a load that was killed at
    any point and is run again is there once. The columns are put in the table's
    order by name; one that the rows lack is NULL, one that the table lacks raises.
    ``buckets`` (how many, by which column) holds for a new table of loads.
    """
    spark = df.sparkSession
    ensure_layers(spark, (layer,))
    full = f"`{layer}`.`{name}`"
    if load_id is None:
        df.write.mode("append").format(fmt).saveAsTable(full)
        return f"{layer}.{name}"
    if not re.fullmatch(r"[0-9A-Za-z_.-]+", load_id):
        raise ValueError(f"A load id has letters, digits, '_', '.' and '-' alone (it names a folder), not {load_id!r}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}, {LOAD_ID} string) USING {fmt} PARTITIONED BY ({LOAD_ID})"
              + (f" CLUSTERED BY (`{buckets[1]}`) INTO {int(buckets[0])} BUCKETS" if buckets else ""))
    table = spark.table(f"{layer}.{name}").schema
    if not table or table.fields[-1].name != LOAD_ID:
        raise ValueError(f"{layer}.{name} is not partitioned by {LOAD_ID}")
    wanted = {f.name: f.dataType for f in table.fields[:-1]}
    unknown = [c for c in df.columns if c not in wanted]
    if unknown:
        raise ValueError(f"{layer}.{name} has no columns {unknown}: its columns were fixed by the first load")
    rows = df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in wanted.items()])
    spark.sql(f"INSERT OVERWRITE TABLE {full} PARTITION ({LOAD_ID} = '{_quoted(load_id)}') SELECT * FROM {{rows}}", rows=rows)
    return f"{layer}.{name}"


def load_ids(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """The loads of a table, from its partitions alone (no data is read)."""
    found = spark.sql(f"SHOW PARTITIONS `{layer}`.`{name}`")
    return found.select(F.regexp_extract("partition", f"^{LOAD_ID}=(.*)$", 1).alias(LOAD_ID))


@contextmanager
def only_writer(spark: SparkSession, name: str, wait_s: float = 60, stale_s: float = 3600) -> Iterator[None]:
    """Hold the lock of table ``name`` (``layer.table``): a file that is created only if it is absent.

    Another holder is waited for up to ``wait_s``, then this raises, with nothing
    written. A lock older than ``stale_s``, left by a driver that was lost, is taken
    over. Creating a file if absent is atomic on local disks and HDFS; on a store
    where it is not, two writers that ask within one round trip may both get it.
    """
    layer, table = name.split(".") if "." in name else ("default", name)
    ensure_layers(spark, (layer,))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{spark.catalog.getDatabase(layer).locationUri.rstrip('/')}/_{table}.lock")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path.getParent())
    end = time.monotonic() + wait_s
    while not _created(fs, path):
        try:
            age = time.time() - fs.getFileStatus(path).getModificationTime() / 1000
        except Py4JJavaError:  # released in between
            continue
        if age > stale_s:
            taken = path.suffix(f".{uuid.uuid4().hex}")
            fs.rename(path, taken)  # one of several that find it stale moves it away
            fs.delete(taken, False)
        elif time.monotonic() >= end:
            raise RuntimeError(f"Another writer holds {path.toString()}; nothing was written")
        else:
            time.sleep(0.2)
    try:
        yield
    finally:
        fs.delete(path, False)


def _created(fs, path) -> bool:
    """Create an empty file; False if it is there."""
    if path.toUri().getScheme() in (None, "file"):  # Hadoop's local file system looks first and creates then
        try:
            with open(path.toUri().getPath(), "x"):
                return True
        except FileExistsError:
            return False
    try:
        fs.create(path, False).close()
        return True
    except Py4JJavaError:
        if fs.exists(path):
            return False
        raise


def row_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, n) for every given table, one global count each."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n"
        )
        for (layer, name), df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_exists(spark: SparkSession, layer: str, name: str) -> bool:
    return spark.catalog.tableExists(f"{layer}.{name}")
