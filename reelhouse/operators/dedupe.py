"""Keep-first-of-group, the one window pattern of the silver layer.

``row_number() over (partition by K order by O) = 1`` is kept as a window so
that Catalyst plans it as a window group limit: every map task first keeps its
own best row per key (partial limit) and only those rows are shuffled. A hot key
(the NULL key, or one film that holds a third of the rows) therefore never
sends more than one row per map task across the network.

Both sides sort all rows by the key. A sort compares the first eight bytes of the
first column before anything else, and those of a URI are the same in all rows, so
the key is led by its own hash, which splits no group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.operators.order import SortSpec, keys, sort_names, tiebreak

RN = "__rn"
# Types whose equal values have equal hashes (not so: text of another collation).
HASHED = ("string", "date", "timestamp", "timestamp_ntz", "boolean", "tinyint", "smallint", "int", "bigint")


def keep_first(
    df: DataFrame,
    partition_by: Sequence[str],
    order: Sequence[SortSpec],
    total: bool = True,
) -> DataFrame:
    """One row per distinct ``partition_by`` (NULLs form a group of their own).

    ``order`` picks the row; with ``total`` every remaining column is appended
    ascending with NULLs last, so the choice is deterministic (also across task
    retries) where the source order left it arbitrary.
    """
    order_keys = keys(order)
    if total:
        order_keys += tiebreak(df.columns, [*partition_by, *sort_names(order)])
    if not order_keys:
        raise ValueError("keep_first needs at least one order key")
    hashed = [c for c, t in df.dtypes if c in partition_by and (t in HASHED or t.startswith("decimal"))]
    lead = [F.hash(*hashed)] if hashed else []
    w = Window.partitionBy(*lead, *partition_by).orderBy(*order_keys)
    return df.withColumn(RN, F.row_number().over(w)).where(F.col(RN) == 1).drop(RN)
