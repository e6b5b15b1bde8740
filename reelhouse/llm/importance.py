"""Target-distribution importance resampling over hashed n-grams.

1. Feature buckets are counted over both tables. A task sums its own buckets,
   so ``BUCKETS`` rows a task are shuffled whatever the texts' size.
2. Texts are scored by arrays: words are cut out of a batch's bytes at once,
   CRC-32 of a run of words follows from those of its words (a CRC is linear), and
   a weight is a sum of gathered gains. Scored rows are written once.
3. The cutoff is found exactly by weighted median of medians: each task tells
   the median of its remaining keys and how many it has; the median of those,
   weighted by the counts, has at least a quarter of the remaining keys on
   either side, so each round discards at least that share. A task tells the
   medians of both sides of the pivot, so a round is one pass. What remains is
   written anew when it is an eighth of the table in use.
4. The winners alone are sorted: by range over the whole key, which is unique.

Defined results: a null or empty text has no features and weight 0; a null id
is hashed as the empty string and sorts before any other; rows that share id and
score are ordered by the hash of their text, rows that repeat id and text by
their place in the scored table (their results differ in rank alone); an empty
table gives an empty result; an empty target gives gains by its smoothed counts.
Only id and text are read. Long texts are scored in pieces with two words of
overlap, so memory is that of a piece or of the longest word.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import portions, small_frame, stage, table

BUCKETS, RUN, SEED, LEAST_WORDS, PERCENT = 10_000, 3, 42, 20, 5
#: Text bytes that are scored at once.
PIECE = 4 << 20
#: Words of up to this many bytes are hashed column by column, others one by one.
SHORT = 48
LEAST_ID = -(1 << 63)

# --- CRC-32 by arrays ------------------------------------------------------------


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _byte_table()


def _applied(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear operator, given by its values on each of four bytes, on ``c``."""
    return (tables[0][c & 255] ^ tables[1][(c >> np.uint32(8)) & 255]
            ^ tables[2][(c >> np.uint32(16)) & 255] ^ tables[3][c >> np.uint32(24)])


def _one_zero_byte() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    values = [c << np.uint32(8 * k) for k in range(4)]
    return np.stack([_CRC[v & 255] ^ (v >> np.uint32(8)) for v in values])


def _operators() -> tuple[np.ndarray, np.ndarray]:
    """Operators that append 0 to SHORT + 1 zero bytes, and 2**k of them."""
    one = _one_zero_byte()
    c = np.arange(256, dtype=np.uint32)
    few = [np.stack([c << np.uint32(8 * k) for k in range(4)])]
    while len(few) < SHORT + 2:
        few.append(_applied(one, few[-1]))
    powers = [one]
    while len(powers) < 40:
        powers.append(_applied(powers[-1], powers[-1]))
    return np.stack(few), np.stack(powers)


_FEW, _POWERS = _operators()
_FLAT = _FEW.reshape(-1)


def moved(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The part of ``c`` in the CRC of a string that goes on for ``n`` bytes."""
    at = np.minimum(n, SHORT + 1).astype(np.int64) << 10
    out = (_FLAT[at + (c & 255)] ^ _FLAT[at + 256 + ((c >> np.uint32(8)) & 255)]
           ^ _FLAT[at + 512 + ((c >> np.uint32(16)) & 255)] ^ _FLAT[at + 768 + (c >> np.uint32(24))])
    far = np.flatnonzero(n > SHORT + 1)
    if len(far):
        x, left = c[far], n[far]
        for k in range(int(left.max()).bit_length()):
            x = np.where((left >> k) & 1, _applied(_POWERS[k], x), x)
        out[far] = x
    return out


def word_crcs(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of every word."""
    clipped = np.minimum(length, SHORT + 1).astype(np.uint8)
    order = np.argsort(clipped, kind="stable")[::-1]
    at, sizes = start[order], clipped[order]
    c = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    longer = len(order) - np.cumsum(np.bincount(sizes, minlength=SHORT + 2))
    for k in range(SHORT):
        n = int(longer[k])
        if not n:
            break
        c[:n] = _CRC[(c[:n] ^ codes[at[:n] + k]) & 255] ^ (c[:n] >> np.uint32(8))
    out = np.empty_like(c)
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > SHORT).tolist():
        out[i] = zlib.crc32(codes[start[i]:start[i] + length[i]])
    return out


# --- features ----------------------------------------------------------------------
_KEEP = np.zeros(256, dtype=np.uint8)
for _a, _b in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _KEEP[_a:_b] = np.arange(_a, _b)
_KEEP[0x41:0x5B] = np.arange(0x61, 0x7B)
_WORD = rb"[0-9A-Za-z\x80-\xff]"
_AHEAD = re.compile(rb"[^0-9A-Za-z\x80-\xff]*+(?:" + _WORD + rb"++[^0-9A-Za-z\x80-\xff]*+){0,2}")
_REST = re.compile(_WORD + rb"*+")


def pieces(text: bytes) -> Iterator[tuple[bytes, int]]:
    """(piece, bytes of it in which features begin); the rest are the two words that follow."""
    start = 0
    while len(text) - start > PIECE:
        cut = _REST.match(text, start + PIECE).end()
        yield text[start:_AHEAD.match(text, cut).end()], cut - start
        start = cut
    yield text[start:], len(text) - start


def features(parts: list[tuple[bytes, int]]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Part of each first word, and per run length (places among the first words, buckets)."""
    sizes = np.array([len(p) + 1 for p, _ in parts], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    codes = _KEEP[np.frombuffer(b"\n".join(p for p, _ in parts), dtype=np.uint8)]
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = codes != 0
    edges = np.flatnonzero(np.diff(inside))
    start, length = edges[::2], edges[1::2] - edges[::2]
    part = np.searchsorted(begin, start, side="right") - 1
    first = start - begin[part] < np.array([n for _, n in parts], dtype=np.int64)[part]
    own = word_crcs(codes, start, length)
    # The word with a space before it, as what a run goes on with.
    next_ = moved(np.full(len(own), zlib.crc32(b" "), dtype=np.uint32), length) ^ own
    places, at = np.cumsum(first) - 1, np.flatnonzero(first)
    out, crc = [], own
    for k in range(RUN):
        if k:
            crc = moved(crc[:-1], length[k:] + 1) ^ next_[k:] if len(crc) > 1 else crc[:0]
        ok = np.flatnonzero(first[:len(crc)] & (part[:len(crc)] == part[k:k + len(crc)]))
        out.append((places[ok], crc[ok] % np.uint32(BUCKETS)))
    return part[at], out


def bucket_counts(texts: DataFrame, text_col: str) -> np.ndarray:
    """Features per bucket over all texts: BUCKETS numbers, summed in tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in portions(batch, 0, PIECE):
                for parts, _ in _grouped(part.column(0).to_pylist()):
                    for _, bucket in features(parts)[1]:
                        total += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    found = texts.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def _grouped(texts: list[bytes | None]) -> Iterator[tuple[list[tuple[bytes, int]], list[int]]]:
    """Pieces of texts, about PIECE bytes at a time, with the text of each."""
    parts, rows, size = [], [], 0
    for i, text in enumerate(texts):
        for p in pieces(text or b""):
            parts.append(p)
            rows.append(i)
            size += len(p[0])
            if size >= PIECE:
                yield parts, rows
                parts, rows, size = [], [], 0
    if parts:
        yield parts, rows


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    above = (target + 1).astype(np.float64) * float(source.sum() + BUCKETS)
    below = (source + 1).astype(np.float64) * float(target.sum() + BUCKETS)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def scored(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """doc_id, id, mark, n_words, n_features, weight, score of every row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2, PIECE):
                words = np.zeros(part.num_rows, dtype=np.int64)
                weight = np.zeros(part.num_rows, dtype=np.int64)
                count = np.zeros(part.num_rows, dtype=np.int64)
                for parts, rows in _grouped(part.column(2).to_pylist()):
                    of, runs = features(parts)
                    of = np.array(rows, dtype=np.int64)[of]
                    words += np.bincount(of, minlength=part.num_rows)
                    sums = np.zeros(len(of), dtype=np.int64)
                    for places, bucket in runs:
                        sums[places] += gain[bucket]
                        count += np.bincount(of[places], minlength=part.num_rows)
                    ends = np.flatnonzero(np.r_[of[1:] != of[:-1], True]) if len(of) else of
                    total = np.cumsum(sums)[ends]
                    np.add.at(weight, of[ends], np.diff(total, prepend=0))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(words), pa.array(count), pa.array(weight)],
                    ["doc_id", "mark", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                       F.col(text_col).cast("binary").alias("text"))
    out = rows.mapInArrow(weigh, "doc_id long, mark long, n_words long, n_features long, weight long")
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return out.withColumns({"id": F.coalesce("doc_id", F.lit(LEAST_ID)), "score": F.col("weight") + noise})


# --- selection -----------------------------------------------------------------------
KEY = ["neg", "id", "mark", "row"]


def _less(keys: list[np.ndarray], bound: tuple) -> np.ndarray:
    """Keys that are lexicographically below ``bound``."""
    out = np.zeros(len(keys[0]), dtype=bool)
    for column, b in zip(keys[::-1], bound[::-1]):
        out = (column < b) | ((column == b) & out)
    return out


def nth(keys: list[np.ndarray], n: int) -> tuple:
    """The n-th smallest key (from 0), column by column, in linear time."""
    out = []
    for k in range(len(keys)):
        v = np.partition(keys[k], n)[n]
        out.append(int(v))
        n -= int((keys[k] < v).sum())
        same = keys[k] == v
        keys = [c[same] for c in keys]
    return tuple(out)


def _told(keys: list[np.ndarray]) -> list:
    n = len(keys[0])
    return [n, *(nth(keys, (n - 1) // 2) if n else (0,) * len(KEY))]


def _round(low: tuple | None, high: tuple | None, pivot: tuple | None) -> tuple[Callable, str]:
    """A task's counts and medians of the remaining keys below and above the pivot."""
    names = [f"{side}_{c}" for side in ("below", "above") for c in ("n", *KEY)]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[] for _ in KEY]
        for batch in batches:
            keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keep = np.ones(len(keys[0]), dtype=bool)
            if low is not None:
                keep &= ~_less(keys, (*low[:-1], low[-1] + 1))
            if high is not None:
                keep &= _less(keys, high)
            for out, c in zip(got, keys):
                out.append(c[keep])
        keys = [np.concatenate(c) if c else np.empty(0, np.int64) for c in got]
        if pivot is None:
            row = [*_told(keys), *_told([c[:0] for c in keys])]
        else:
            below = _less(keys, pivot)
            above = ~_less(keys, (*pivot[:-1], pivot[-1] + 1))
            row = [*_told([c[below] for c in keys]), *_told([c[above] for c in keys])]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names)

    return tell, ", ".join(f"{n} long" for n in names)


def weighted_median(medians: list[tuple[int, tuple]]) -> tuple:
    """The least key at which half of the weight is reached."""
    half, have = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda m: m[1]):
        have += n
        if have >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, want: int) -> tuple | None:
    """The ``want``-th smallest of the unique keys (columns KEY), None if there are fewer.

    The driver holds one row a task and round: a count and a median for each side.
    """
    low = high = pivot = None
    staged = None
    while True:
        tell, schema = _round(low, high, pivot)
        rows = keys.mapInArrow(tell, schema).collect()
        sides = [[(r[f"{s}_n"], tuple(r[f"{s}_{c}"] for c in KEY)) for r in rows if r[f"{s}_n"]] for s in ("below", "above")]
        below = sum(n for n, _ in sides[0])
        if pivot is None:
            staged = left = below
            if not 1 <= want <= left:
                return None
            pivot = weighted_median(sides[0])
            continue
        if want == below + 1:
            return pivot
        if want <= below:
            high, left, side = pivot, below, sides[0]
        else:
            low, want, side = pivot, want - below - 1, sides[1]
            left = sum(n for n, _ in side)
        pivot = weighted_median(side)
        if left * 8 <= staged:
            at = F.struct(*KEY)
            if low is not None:
                keys = keys.where(at > F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip(KEY, low))))
            if high is not None:
                keys = keys.where(at < F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip(KEY, high))))
            keys, staged = stage(keys, "importance-remaining"), left


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` from 1 in the order of KEY: one range sort, then places added to the counts before."""
    order = winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("at", F.monotonically_increasing_id())
    order = stage(order.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)}), "importance-winners")
    before, offsets = 0, []
    for r in sorted(order.groupBy("part").count().collect()):  # one row a partition of the sort
        offsets.append((r["part"], before))
        before += r["count"]
    starts = small_frame(winners.sparkSession, offsets, "part long, before long")
    return order.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("at") + 1)


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              target_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row a document: doc_id, n_words, n_features, weight, score, rank (null: not drawn)."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    rows = scored(docs, gain, id_col, text_col)
    rows = stage(rows.withColumns({"neg": -F.col("score"), "row": F.monotonically_increasing_id()}), "importance-scores")
    enough = F.col("n_words") >= LEAST_WORDS
    want = rows.where(enough).count() * percent // 100
    last = cutoff(rows.where(enough).select(*KEY), want) if want else None
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    wins = enough & (F.struct(*KEY) <= F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip(KEY, last))))
    drawn = ranked(rows.where(wins)).select(*out, "rank")
    return drawn.union(rows.where(~wins).select(*out, F.lit(None).cast("long").alias("rank")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
