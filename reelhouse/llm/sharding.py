"""Sharding by histogram sort.

Rows are ordered by (hash of the text, id), so equal texts lie together. The
bytes below candidate boundaries are counted exactly over all partitions; each
round probes only inside the ranges that are not settled: those that hold a
wanted boundary and more bytes than the tolerance, or more rows than one sort
task should take. A range is cut along the hash first and, when it is a single
hash value (a group of equal texts), along the id. So a group is cut only where
the tolerance asks for it, and no group meets in one task. When all boundaries
are settled the rows are exchanged once, into the ranges found, and numbered.

Defined results: a null text has no bytes and sorts as an empty one; a null id
sorts with the smallest id; rows equal in text and id cannot be separated and
stay in one range; an empty table gives an empty result. All columns of the
input are kept under their names; the operator's own are shard and slot, and an
input column of such a name, in any case, is replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import flat, small_frame, stage, table

SHARDS = 16
#: A boundary is settled when it is off by at most this share of a shard.
TOLERANCE = 0.002
#: Ranges are split until each holds at most its share of the rows, of LEAVES ranges or of
#: one for RANGE_BYTES bytes if these are more (RANGE_ROWS rows are always allowed). The
#: driver sees a few times as many ranges: some thousands, a million at 100 TB.
LEAVES, RANGE_ROWS, RANGE_BYTES = 1024, 1000, 256 << 20
#: Up to so many ranges (some 50 MB), the table of them is broadcast.
FEW_RANGES = 1_000_000
#: Bits of the hash that the rounds look at: 12, then 8 more each.
HASH_SHIFTS = (52, 44, 36, 28, 20, 12, 4, 0)


@dataclass
class Range:
    """Rows whose key begins with ``prefix`` at ``level``; ranges are in key order."""

    level: int
    prefix: tuple
    size: int
    rows: int


def text_bytes(text_col: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1


def _keys(df: DataFrame, id_col: str, text_col: str, low: int) -> DataFrame:
    return df.withColumns({
        "__hs_h": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
        "__hs_d": F.coalesce(F.col(id_col).cast("long"), F.lit(low)),
        "__hs_size": text_bytes(text_col),
    })


def _shifts(low: int, high: int) -> list[tuple[int, int | None]]:
    """Bits dropped from hash and id in each round; no id while the hash is not whole."""
    bits = (low ^ high).bit_length() if (low < 0) == (high < 0) else 64
    return [(s, None) for s in HASH_SHIFTS] + [(0, s) for s in [*range(bits - 8, 0, -8), 0]]


def _prefix(shifts: tuple[int, int | None]) -> list[Column]:
    h, d = shifts
    cut = lambda name, s: F.shiftright(name, s) if s else F.col(name)
    return [cut("__hs_h", h)] + ([] if d is None else [cut("__hs_d", d)])


def split_ranges(keyed: DataFrame, shifts: list[tuple[int, int | None]], shards: int, tolerance: float) -> list[Range]:
    """Rounds of exact counting; the driver sees range totals only."""
    spark, levels = keyed.sparkSession, [_prefix(s) for s in shifts]

    def count(df: DataFrame, level: int) -> list[Range]:
        names = [f"p{i}" for i in range(len(levels[level]))]
        rows = (df.groupBy(*[c.alias(n) for c, n in zip(levels[level], names)])
                .agg(F.sum("__hs_size").alias("size"), F.count(F.lit(1)).alias("rows")).collect())
        return sorted((Range(level, tuple(r[n] for n in names), r["size"], r["rows"]) for r in rows),
                      key=lambda r: r.prefix)

    ranges = count(keyed, 0)
    total, n_rows = sum(r.size for r in ranges), sum(r.rows for r in ranges)
    most_rows = max(RANGE_ROWS, n_rows // max(LEAVES, total // RANGE_BYTES))
    most_bytes = tolerance * total / shards
    targets = [total * i / shards for i in range(1, shards)]
    for level in range(len(levels) - 1):
        below, unsettled = 0, []
        for r in ranges:
            cut = bisect_right(targets, below + r.size) > bisect_right(targets, below)
            if r.level == level and r.rows > 1 and (r.rows > most_rows or (cut and r.size > most_bytes)):
                unsettled.append(r.prefix)
            below += r.size
        if not unsettled:
            break
        names = [f"o{i}" for i in range(len(levels[level]))]
        probes = small_frame(spark, unsettled, ", ".join(f"{n} bigint" for n in names))
        inside = keyed.join(_small(probes, len(unsettled)), [c == F.col(n) for c, n in zip(levels[level], names)], "left_semi")
        children: dict[tuple, list[Range]] = {}
        for r in count(inside, level + 1):
            children.setdefault(_parent(r.prefix, shifts[level], shifts[level + 1]), []).append(r)
        ranges = [c for r in ranges
                  for c in (children[r.prefix] if r.level == level and r.prefix in children else [r])]
    return ranges


def _small(ranges: DataFrame, n: int) -> DataFrame:
    return F.broadcast(ranges) if n <= FEW_RANGES else ranges


def _parent(prefix: tuple, at: tuple[int, int | None], next_at: tuple[int, int | None]) -> tuple:
    """Prefix in one round of a prefix in the next."""
    if next_at[1] is None:
        return (prefix[0] >> (at[0] - next_at[0]),)
    return (prefix[0],) if at[1] is None else (prefix[0], prefix[1] >> (at[1] - next_at[1]))


def histogram_shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    rows, back, (id_, text) = flat(docs, id_col, text_col)
    own = [c for c, name in zip(back, docs.columns) if name.lower() not in ("shard", "slot")]
    low, high = rows.agg(F.min(F.col(id_).cast("long")), F.max(F.col(id_).cast("long"))).first()
    low, high = (low, high) if low is not None else (0, 0)
    keyed = _keys(rows, id_, text, low)
    shifts = _shifts(low, high)
    levels = [_prefix(s) for s in shifts]
    ranges = split_ranges(stage(keyed.select("__hs_h", "__hs_d", "__hs_size"), "shard-keys"), shifts, shards, tolerance)

    total = max(1, sum(r.size for r in ranges))
    below, slots, places = 0, [0] * shards, {}
    for i, r in enumerate(ranges):
        shard = min(shards - 1, int((below + r.size / 2) * shards / total))
        places.setdefault(r.level, []).append((*r.prefix, i, shard, slots[shard]))
        slots[shard] += r.rows
        below += r.size
    placed, found = keyed, []
    for level, rows in places.items():
        names = [f"__hs_p{level}_{i}" for i in range(len(levels[level]))]
        cols = [f"__hs_{level}_{x}" for x in ("range", "shard", "base")]
        at = small_frame(spark, rows, ", ".join(f"{n} bigint" for n in names + cols))
        placed = placed.join(_small(at, len(rows)), [c == F.col(n) for c, n in zip(levels[level], names)], "left")
        found.append(cols)
    pick = lambda k: F.coalesce(*[F.col(c[k]) for c in found], F.lit(0).cast("long"))
    placed = placed.withColumns({"__hs_range": pick(0), "__hs_shard": pick(1), "__hs_base": pick(2)})
    order = Window.partitionBy("__hs_range").orderBy("__hs_h", "__hs_d", "__hs_size")
    return placed.select(
        *own,
        F.col("__hs_shard").cast("int").alias("shard"),
        (F.col("__hs_base") + F.row_number().over(order) - 1).alias("slot"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        text_bytes().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return histogram_shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
