"""Q2 kept up per load: how often each value is in an append-only table.

Beside a table of loads lies a state of (column, digest of the value, count), a
partition for each load and bucketed by digest. A new load is counted from its own
partition; the check then sums the counts of the state, bucket by bucket, and
never reads the loads before it. Counting a load again replaces its partition, so
a refresh that was killed is made whole by the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.plans import catalog

STATE_SCHEMA = "column_name string, digest binary, n long"
BUCKETS = 64


def state_name(table: str) -> str:
    return f"{table}__value_counts"


def _digest(columns: Sequence[str]) -> F.Column:
    """256 bits of a value, or of a tuple of them; NULL if one is NULL."""
    texts = [F.col(c).cast("string") for c in columns]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.unhex(F.sha2(F.concat(*sized).cast("binary"), 256))


def value_counts(rows: DataFrame, columns: Sequence[str | Sequence[str]]) -> DataFrame:
    """(column_name, digest, n) of the non-NULL values; a tuple of columns is named by
    their names with commas. One scan; a value has one row a task before the shuffle."""
    tuples = [(c,) if isinstance(c, str) else tuple(c) for c in columns]
    pairs = F.array(*[F.struct(F.lit(",".join(t)).alias("column_name"), _digest(t).alias("digest")) for t in tuples])
    values = rows.select(F.inline(pairs)).where(F.col("digest").isNotNull())
    return values.groupBy("column_name", "digest").agg(F.count(F.lit(1)).alias("n"))


def merged(*counts: DataFrame) -> DataFrame:
    """The counts of several loads as one."""
    return reduce(DataFrame.unionByName, counts).groupBy("column_name", "digest").agg(F.sum("n").alias("n"))


def failures(state: DataFrame, columns: Sequence[str | Sequence[str]]) -> DataFrame:
    """(column_name, failures): values seen more than once over all loads of ``state``,
    a row for every one of ``columns``."""
    names = [c if isinstance(c, str) else ",".join(c) for c in columns]
    found = state.groupBy("column_name", "digest").agg(F.sum("n").alias("n")).groupBy("column_name").agg(F.count_if(F.col("n") > 1).alias("failures"))
    wanted = state.sparkSession.createDataFrame([(n,) for n in names], "column_name string")
    return wanted.join(found, "column_name", "left").select("column_name", F.coalesce("failures", F.lit(0)).alias("failures"))


def refresh(spark: SparkSession, layer: str, table: str, columns: Sequence[str | Sequence[str]]) -> DataFrame:
    """Count the loads of ``layer.table`` that the state lacks, whoever loaded them, and
    return ``failures``. The names of those loads come to the driver, no rows do."""
    state = state_name(table)
    loads = catalog.load_ids(spark, layer, table)
    if catalog.table_exists(spark, layer, state):
        loads = loads.join(catalog.load_ids(spark, layer, state), catalog.LOAD_ID, "left_anti")
    for load_id in sorted(r[0] for r in loads.select(catalog.LOAD_ID).collect()):
        rows = spark.table(f"{layer}.{table}").where(F.col(catalog.LOAD_ID) == load_id)
        counts = value_counts(rows, columns).repartition(BUCKETS, "digest")
        catalog.append_table(counts, layer, state, load_id=load_id, buckets=(BUCKETS, "digest"))
    if not catalog.table_exists(spark, layer, state):
        return failures(spark.createDataFrame([], STATE_SCHEMA), columns)
    return failures(spark.table(f"{layer}.{state}"), columns)
