"""Sort keys with explicit null order, tie-breaks and top-k.

The layered models were written for a database where DESC sorts NULLs first and
ASC sorts them last; Spark's defaults are the other way round. Every sort key
here therefore names its null order, and helpers build the keys from short
specs such as ``"rating desc"`` or ``"name asc"`` with the database's defaults.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SortSpec = str | Column


def key(spec: SortSpec) -> Column:
    """Sort key from ``"col [asc|desc] [nulls first|last]"``.

    Without an explicit null order, ``desc`` puts NULLs first and ``asc`` puts
    them last (the warehouse's defaults, not Spark's).
    """
    if isinstance(spec, Column):
        return spec
    parts = spec.split()
    name = parts[0] if parts else ""
    rest = [p.lower() for p in parts[1:]]
    allowed = ([], ["asc"], ["desc"], ["nulls", "first"], ["nulls", "last"],
               ["asc", "nulls", "first"], ["asc", "nulls", "last"],
               ["desc", "nulls", "first"], ["desc", "nulls", "last"])
    if not name or rest not in [list(a) for a in allowed]:
        raise ValueError(f"bad sort spec {spec!r}: use 'col [asc|desc] [nulls first|last]'")
    desc = "desc" in rest
    first = rest[-1] == "first" if "nulls" in rest else desc
    c = F.col(name)
    if desc:
        return c.desc_nulls_first() if first else c.desc_nulls_last()
    return c.asc_nulls_first() if first else c.asc_nulls_last()


def keys(specs: Iterable[SortSpec]) -> list[Column]:
    return [key(s) for s in specs]


def tiebreak(columns: Sequence[str], used: Iterable[str] = ()) -> list[Column]:
    """Remaining columns ascending, NULLs last: makes an order total.

    Rows that still tie after these keys are equal in every column, so any of
    them gives the same result.
    """
    seen = set(used)
    return [F.col(c).asc_nulls_last() for c in columns if c not in seen]


def sort_names(specs: Iterable[SortSpec]) -> list[str]:
    return [s.split()[0] for s in specs if isinstance(s, str)]


def rank_order(df: DataFrame, order: Sequence[SortSpec], total: bool = True) -> list[Column]:
    """Keys of ``order`` plus, when ``total``, every other column as tie-break."""
    ks = keys(order)
    if total:
        ks += tiebreak(df.columns, sort_names(order))
    return ks


def sort(df: DataFrame, order: Sequence[SortSpec], total: bool = True) -> DataFrame:
    """Global sort (range shuffle) with explicit null order."""
    return df.orderBy(*rank_order(df, order, total))


def top_k(df: DataFrame, order: Sequence[SortSpec], k: int, total: bool = True) -> DataFrame:
    """First ``k`` rows in ``order``; planned as TakeOrderedAndProject, so each
    task keeps only its own k best rows and no full sort or shuffle happens."""
    if k < 0:
        raise ValueError("k must be >= 0")
    return df.orderBy(*rank_order(df, order, total)).limit(k)


def peek(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, for inspection (no order promised)."""
    return df.limit(n)
