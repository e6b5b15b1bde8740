"""Removal of repeated passages by a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier
(in a smaller id, or earlier in the same text). Suffixes are sorted where it
matters only, at anchors: positions whose ``GRAM`` bytes have the least hash of
all in some string of ``LENGTH`` bytes. Equal strings have equal anchors at
equal places, so a repeated string shows at its anchors, and its bytes lie in
the anchor's region: ``LENGTH - GRAM`` bytes before it, ``LENGTH`` from it on.

1. Each block of texts sends the first holder of every (anchor, region) to the
   shard of the anchor's hash. Of equal regions all but the earliest are
   repeated as a whole. A block keeps its own repeats, so a passage that is in
   every text crosses the network once per block. Regions of equal hash are
   confirmed byte by byte in their block, and by 64 bits of another hash, taken of
   the same bytes, between blocks.
2. Earliest holders of regions that differ but have an anchor in common, that
   is the ends of passages, send their bytes. In a shard, the suffixes at the
   anchors are sorted by merging; two suffixes are compared at the end of their
   common extension, which a binary search over prefix polynomial hashes finds.
   Neighbours in the order bound the common extension of an anchor with any
   other, so only strings within that bound are looked up, by the same hashes,
   and equal hashes are confirmed byte by byte. An anchor with more different
   regions than a shard of this step holds (a passage with other words around it
   in very many texts) is split: each string of its regions is looked up by 128
   bits of hash, which spreads them over all tasks, and all but the earliest of
   equal strings are repeated.
3. The spans found are merged per text and cut out.

Defined results: null and empty texts lose nothing; bytes are those of the
UTF-8 text, and spans may cut characters; a null id is smaller than any other;
texts that share an id are ordered by their hash; rows that repeat id and text
are one document; an empty table gives an empty result. Only id and text are
read. Texts are whole whatever their length (they are scanned in overlapping
pieces).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.arrays import pack, unpack
from reelhouse.llm.common import portions, stage, table

LENGTH, GRAM = 100, 32
LEFT = LENGTH - GRAM
SPAN = LEFT + LENGTH
#: Text bytes to a block, to a shard of step 1, and region bytes to a shard of step 2.
BLOCK_BYTES, SHARD_BYTES, FINE_BYTES = 16 << 20, 32 << 20, 4 << 20
#: Regions that an anchor has in one shard of step 2; beyond, its strings are spread.
HOT_REGIONS = FINE_BYTES // SPAN
#: Longest piece that is hashed at once.
PIECE, MARGIN = 1 << 20, 2 * SPAN

_RNG = np.random.default_rng(10)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the base, and of its inverse modulo 2**64, for one piece."""
    if not _POWERS:
        n = PIECE + 2 * MARGIN + 1
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, b, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash, a row of bytes each (last axis)."""
    out = np.zeros(codes.shape[:-1] + (codes.shape[-1] + 1,), dtype=np.uint64)
    np.cumsum(_VALUE[codes] * _powers()[0][:codes.shape[-1]], axis=-1, out=out[..., 1:])
    return out


def _least(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = best(x[:len(x) - step], x[step:])
        have += step
    return x


def anchors(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors of one piece."""
    n = len(codes)
    if n < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums, inverse = prefix_hashes(codes), _powers()[1]
    h = (sums[GRAM:] - sums[:-GRAM]) * inverse[:n - GRAM + 1]
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h ^= h >> np.uint64(29)
    width = LEFT + 1
    least = _least(h, width, np.minimum)
    # A position is an anchor if it holds the least of some window around it.
    edge = np.zeros(width - 1, dtype=np.uint64)
    most = _least(np.concatenate([edge, least, edge]), width, np.maximum)
    at = np.flatnonzero(h == most)
    return at, h[at]


def text_anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    codes, n = np.frombuffer(text, dtype=np.uint8), len(text)
    if n <= PIECE:
        return anchors(codes)
    found = []
    for a in range(0, n, PIECE):
        start = max(0, a - MARGIN)
        at, h = anchors(codes[start:min(n, a + PIECE + MARGIN)])
        at = at + start
        core = (at >= a) & (at < a + PIECE)
        found.append((at[core], h[core]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def region(at: np.ndarray, n: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(at - LEFT, 0), np.minimum(at + LENGTH, n)


# --- step 1 --------------------------------------------------------------------
HOLDER = np.dtype([("h", "u8"), ("reg", "u8"), ("check", "u8"), ("id", "i8"), ("mark", "i8"), ("at", "u4"), ("n", "u4")])
REPEAT = np.dtype([("id", "i8"), ("mark", "i8"), ("start", "u4"), ("end", "u4")])


def _records(dtype: np.dtype, *columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(columns[0]), dtype)
    for name, c in zip(dtype.names, columns):
        out[name] = c
    return out


def block_parts(ids: np.ndarray, marks: np.ndarray, texts: list[bytes | None], shards: int) -> Iterator[tuple[int, bytes]]:
    """Payload per shard of a block: holders (hash, region, its second hash, id, mark, position, bytes of text), and the block's own repeats in one of them."""
    order = np.lexsort((marks, ids))
    rows = order[np.r_[True, (np.diff(ids[order]) != 0) | (np.diff(marks[order]) != 0)]] if len(order) else order
    hs, digests, rank, ats, ns = [], [], [], [], []
    for r, i in enumerate(rows):
        text = texts[i] or b""
        at, h = text_anchors(text)
        if len(at):
            lo, hi = region(at, len(text))
            hs.append(h)
            view = memoryview(text)
            digests += [xxhash.xxh3_128_digest(view[a:b], a - p + LEFT) for a, b, p in zip(lo.tolist(), hi.tolist(), at.tolist())]
            rank.append(np.full(len(at), r))
            ats.append(at)
            ns.append(np.full(len(at), len(text)))
    if not hs:
        return
    h, rank, at, n = (np.concatenate(x) for x in (hs, rank, ats, ns))
    reg, check = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2).T
    by = np.lexsort((at, rank, reg, h))
    h, reg, check, rank, at, n = (x[by] for x in (h, reg, check, rank, at, n))
    first = np.r_[True, (h[1:] != h[:-1]) | (reg[1:] != reg[:-1])]
    lo, hi = region(at, n)
    # The bytes themselves: a region that differs from the first of its hash is a holder of its own.
    again = np.flatnonzero(~first)
    head = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))[again]
    owners = rows[rank].tolist()
    lows, highs = lo.tolist(), hi.tolist()
    same = np.fromiter((texts[owners[k]][lows[k]:highs[k]] == texts[owners[f]][lows[f]:highs[f]] for k, f in zip(again.tolist(), head.tolist())), bool, len(again))
    first[again[~same]] = True
    start, end, owner = merged(rank[~first], lo[~first], hi[~first])
    # Holders in the order of their shards, cut where these change.
    shard = (h % np.uint64(shards)).astype(np.int64)
    k = np.flatnonzero(first)
    k = k[np.argsort(shard[k], kind="stable")]
    who = rows[rank[k]]
    holders = _records(HOLDER, h[k], reg[k], check[k], ids[who], marks[who], at[k], n[k])
    cut = np.flatnonzero(np.diff(shard[k])) + 1
    parts = dict(zip(shard[k[np.r_[0, cut]]].tolist(), np.split(holders, cut)))
    repeats, none = _records(REPEAT, ids[rows[owner]], marks[rows[owner]], start, end), np.empty(0, REPEAT)
    own = int(ids[rows[0]] % shards)  # repeats of the block travel with one of its parts
    if len(repeats):
        parts.setdefault(own, holders[:0])
    for s, part in parts.items():
        yield s, pack(part, repeats if s == own else none)


def merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans joined where they overlap or touch: start, end, owner."""
    if not len(owner):
        return start, end, owner
    by = np.lexsort((start, owner))
    owner, start, end = owner[by], start[by], end[by]
    # Ends running within an owner: owners are apart by more than any position.
    lift = np.unique(owner, return_inverse=True)[1].astype(np.int64) * (int(end.max()) + 2)
    run = np.maximum.accumulate(end + lift)
    new = np.r_[True, start[1:] + lift[1:] > run[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(new) - 1]
    return start[new], run[last] - lift[last], owner[new]


def _columns(parts: list[np.ndarray], dtype: np.dtype) -> list[np.ndarray]:
    records = np.concatenate(parts).view(dtype)
    return [np.ascontiguousarray(records[name]) for name in dtype.names]


def decided(data: list[bytes]) -> pa.Table:
    """One shard of step 1: (doc_id, mark, start, end, anchor); anchor is null for a span to remove."""
    parts = [unpack(d) for d in data]
    h, reg, check, ids, marks, at, n = _columns([p[0] for p in parts], HOLDER)
    rid, rmark, rstart, rend = _columns([p[1] for p in parts], REPEAT)
    by = np.lexsort((at, marks, ids, check, reg, h))
    h, reg, check, ids, marks, at, n = (x[by] for x in (h, reg, check, ids, marks, at.astype(np.int64), n.astype(np.int64)))
    new = np.r_[True, (h[1:] != h[:-1]) | (reg[1:] != reg[:-1]) | (check[1:] != check[:-1])] if len(h) else np.empty(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    # The same place of the same text as the earliest is the earliest.
    repeat = (ids != ids[head]) | (marks != marks[head]) | (at != at[head])
    lo, hi = region(at, n)
    # Anchors with more than one region: their earliest holders are compared in step 2.
    heads = np.flatnonzero(new)
    alone = np.r_[True, h[heads][1:] != h[heads][:-1]] & np.r_[h[heads][1:] != h[heads][:-1], True] if len(heads) else np.empty(0, bool)
    fine = heads[~alone]
    return pa.table({
        "doc_id": np.concatenate([rid, ids[repeat], ids[fine]]), "mark": np.concatenate([rmark, marks[repeat], marks[fine]]),
        "start": np.concatenate([rstart.astype(np.int64), lo[repeat], at[fine]]),
        "end": np.concatenate([rend.astype(np.int64), hi[repeat], at[fine]]),
        "anchor": pa.array(np.concatenate([np.zeros(len(rid) + int(repeat.sum()), np.int64), h[fine].view(np.int64)]),
                           mask=np.r_[np.ones(len(rid) + int(repeat.sum()), bool), np.zeros(len(fine), bool)])})


# --- step 2 ----------------------------------------------------------------------
class Regions:
    """Regions of anchors as rows of SPAN bytes; the anchor is byte LEFT of each."""

    def __init__(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Valid bytes of row i are lo[i] to hi[i]; the others are 0."""
        self.data, self.lo, self.hi = data, lo, hi
        self.sums = prefix_hashes(data)

    def hash(self, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[row, end] - self.sums[row, start]) * _powers()[1][start]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of two suffixes that start at the anchors, by binary search."""
        lo = np.zeros(len(a), dtype=np.int64)
        hi = np.minimum(self.hi[a], self.hi[b]) - LEFT
        for _ in range(LENGTH.bit_length()):
            mid = (lo + hi + 1) >> 1
            same = self.hash(a, np.full(len(a), LEFT), LEFT + mid) == self.hash(b, np.full(len(b), LEFT), LEFT + mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Suffix of a sorts before that of b; a suffix that ends sorts first."""
        at = LEFT + self.common(a, b)
        end_a, end_b = at >= self.hi[a], at >= self.hi[b]
        x, y = self.data[a, np.minimum(at, SPAN - 1)], self.data[b, np.minimum(at, SPAN - 1)]
        return np.where(end_a | end_b, end_a & ~end_b, x < y)

    def sorted(self, group: np.ndarray) -> np.ndarray:
        """Rows in suffix order within their groups (``group`` ascends), by bottom-up merging of all groups at once."""
        n = len(group)
        order = np.arange(n)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        begin = np.repeat(first, np.diff(np.r_[first, n]))
        end = np.repeat(np.r_[first[1:], n], np.diff(np.r_[first, n]))
        width, at = 1, np.arange(n)
        while width < (end - begin).max(initial=0):
            run = (at - begin) // width
            left = run % 2 == 0
            # The neighbouring run of each row's run.
            lo = np.minimum(begin + np.where(left, run + 1, run - 1) * width, end)
            hi = np.minimum(lo + width, end)
            start = begin + (run // 2) * 2 * width
            own = at - (begin + run * width)
            a, low, high = order, lo.copy(), hi.copy()
            open_ = np.flatnonzero(low < high)
            while len(open_):
                mid = (low[open_] + high[open_]) >> 1
                x, y = a[open_], order[mid]
                # Stable: of equals, the left run's come first.
                go = np.where(left[open_], self.less(y, x), ~self.less(x, y))
                low[open_] = np.where(go, mid + 1, low[open_])
                high[open_] = np.where(go, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            merged_at = start + own + (low - lo)
            out = np.empty(n, dtype=order.dtype)
            out[merged_at] = order
            order, width = out, width * 2
        return order


def repeated_strings(h: np.ndarray, ids: np.ndarray, marks: np.ndarray, at: np.ndarray, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, start in the region) of strings of LENGTH bytes that an earlier row of the same anchor has at the same place.

    Rows are sorted by h, then by id, mark and position.
    """
    regions = Regions(data, lo, hi)
    order = regions.sorted(h)
    # Longest common extension with any other row of the group: with a neighbour.
    near = np.zeros(len(h), dtype=np.int64)
    if len(h) > 1:
        pair = np.flatnonzero(h[order][1:] == h[order][:-1])
        ext = regions.common(order[pair], order[pair + 1])
        np.maximum.at(near, order[pair], ext)
        np.maximum.at(near, order[pair + 1], ext)
    # Strings start between lo and the anchor and end within hi and the extension.
    first, last = lo, np.minimum(LEFT, np.minimum(hi, LEFT + near) - LENGTH)
    many = np.maximum(last - first + 1, 0)
    row = np.repeat(np.arange(len(h)), many)
    start = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    key = regions.hash(row, start, start + LENGTH)
    by = np.lexsort((row, key, start, h[row]))
    row, start, key = row[by], start[by], key[by]
    new = np.r_[True, (key[1:] != key[:-1]) | (start[1:] != start[:-1]) | (h[row][1:] != h[row][:-1])] if len(row) else np.empty(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    hit = np.flatnonzero((row != row[head]) & ((ids[row] != ids[row[head]]) | (marks[row] != marks[row[head]]) | (at[row] != at[row[head]])))
    # Collision check: the bytes themselves, some rows at a time.
    sure = []
    for k in range(0, len(hit), 20_000):
        p = hit[k:k + 20_000]
        cols = start[p][:, None] + np.arange(LENGTH)
        sure.append((data[row[p][:, None], cols] == data[row[head[p]][:, None], cols]).all(axis=1))
    hit = hit[np.concatenate(sure)] if sure else hit
    return row[hit], start[hit]


def compared(data: list[bytes]) -> pa.Table:
    """One shard of step 2: spans (doc_id, mark, start, end) to remove."""
    parts = [unpack(d) for d in data]
    h, ids, marks, at, lo, hi, flat = (np.concatenate([p[k] for p in parts]) for k in range(7))
    by = np.lexsort((at, marks, ids, h))
    h, ids, marks, at, lo, hi = (x[by] for x in (h, ids, marks, at.astype(np.int64), lo.astype(np.int64), hi.astype(np.int64)))
    rows = flat.reshape(-1, SPAN)[by]
    row, start = repeated_strings(h, ids, marks, at, rows, lo, hi)
    first = at[row] - LEFT + start
    a, b, owner = merged(row, first, first + LENGTH)
    return pa.table({"doc_id": ids[owner], "mark": marks[owner], "start": a, "end": b})


def fine_parts(ids: list[int], marks: list[int], texts: list[bytes], ats: list[list[int]], hashes: list[list[int]], shards: int) -> Iterator[tuple[int, bytes]]:
    cols: list[list[np.ndarray]] = [[] for _ in range(7)]
    for i, m, text, at, h in zip(ids, marks, texts, ats, hashes):
        at, h = np.array(at, dtype=np.int64), np.array(h, dtype=np.int64).view(np.uint64)
        codes = np.frombuffer(text, dtype=np.uint8)
        lo, hi = region(at, len(text))
        where = at[:, None] - LEFT + np.arange(SPAN)
        inside = (where >= 0) & (where < len(text))
        rows = np.where(inside, codes[np.clip(where, 0, len(text) - 1)], 0).astype(np.uint8)
        for c, x in zip(cols, (h, np.full(len(at), i), np.full(len(at), m), at, lo - at + LEFT, hi - at + LEFT, rows)):
            c.append(x)
    if not cols[0]:
        return
    h, i, m, at, lo, hi, rows = (np.concatenate(c) for c in cols)
    shard = (h % np.uint64(shards)).astype(np.int64)
    for s in np.unique(shard).tolist():
        k = np.flatnonzero(shard == s)
        yield s, pack(h[k], i[k], m[k], at[k].astype(np.uint32), lo[k].astype(np.uint8), hi[k].astype(np.uint8), rows[k].reshape(-1))


def region_strings(ids: list[int], marks: list[int], texts: list[bytes], ats: list[list[int]]) -> Iterator[pa.RecordBatch]:
    """Every string of LENGTH bytes in the regions at ``ats``: (k1, k2: its hash, doc_id, mark, at, start), some texts at a time."""
    names = ["k1", "k2", "doc_id", "mark", "at", "start"]
    digests: list[bytes] = []
    rows: list[tuple[int, int, int, int]] = []

    def batch() -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (*keys, *np.array(rows, dtype=np.int64).T)], names)

    for i, m, text, at in zip(ids, marks, texts, ats):
        view = memoryview(text)
        for a in at:
            lo, hi = max(a - LEFT, 0), min(a + LENGTH, len(text))
            for s in range(lo, hi - LENGTH + 1):
                digests.append(xxhash.xxh3_128_digest(view[s:s + LENGTH]))
                rows.append((i, m, a, s))
        if len(rows) >= 100_000:
            yield batch()
            digests, rows = [], []
    if rows:
        yield batch()


# --- the operator -----------------------------------------------------------------
_SPANS = "doc_id long, mark long, start long, end long"


def _sent(batches: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for s, data in batches:
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([data], pa.binary())], ["shard", "data"])


def removed_spans(rows: DataFrame, n_bytes: int) -> DataFrame:
    """Merged spans of (doc_id, mark): arrays ``start`` and ``end``; ids are not null here."""
    shards = max(8, -(-n_bytes // SHARD_BYTES))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2, BLOCK_BYTES):
                yield from _sent(block_parts(part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2).to_pylist(), shards))

    def decide(shard: pa.Table) -> pa.Table:
        return decided(shard["data"].to_pylist())

    sent = rows.where(F.octet_length("text") >= LENGTH).mapInArrow(scan, "shard int, data binary")
    found = stage(sent.groupBy("shard").applyInArrow(decide, _SPANS + ", anchor long"), "passages")
    of = found.where(F.col("anchor").isNotNull())
    hot = stage(of.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_REGIONS).select("anchor"), "passage-hot")
    some_hot = not hot.isEmpty()
    few = stage(of.join(hot, "anchor", "left_anti"), "passage-few") if some_hot else of
    fine_shards = max(8, -(-few.count() * SPAN // FINE_BYTES))

    def told(ends: DataFrame, name: str) -> DataFrame:
        """(doc_id, mark, text, start, anchor) of the texts with these ends of passages."""
        at = ends.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "anchor")).alias("at"))
        at = stage(at.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), "at"), name)
        with_text = rows.join(at, (F.col("doc_id") == F.col("__id")) & (F.col("mark") == F.col("__mark")))
        return with_text.select("doc_id", "mark", "text", F.col("at.start").alias("start"), F.col("at.anchor").alias("anchor"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2, BLOCK_BYTES // 4):
                yield from _sent(fine_parts(*(c.to_pylist() for c in part.columns), fine_shards))

    def compare(shard: pa.Table) -> pa.Table:
        return compared(shard["data"].to_pylist())

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2, BLOCK_BYTES // 4):
                yield from region_strings(*(c.to_pylist() for c in part.columns))

    ends = told(few, "passage-ends").mapInArrow(gather, "shard int, data binary").groupBy("shard").applyInArrow(compare, _SPANS)
    spans = found.where(F.col("anchor").isNull()).drop("anchor").union(ends)
    if some_hot:
        split = told(of.join(hot, "anchor", "left_semi"), "passage-hot-ends").select("doc_id", "mark", "text", "start")
        each = stage(split.mapInArrow(strings, "k1 long, k2 long, doc_id long, mark long, at long, start long"), "passage-strings")
        first = each.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "mark", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
        again = each.join(stage(first.where("n > 1").select("k1", "k2", "first"), "passage-first"), ["k1", "k2"])
        again = again.where(F.struct("doc_id", "mark", "start") != F.col("first"))
        # Strings of a region all hold its anchor's bytes, so they make one span.
        spans = spans.union(again.groupBy("doc_id", "mark", "at").agg(F.min("start").alias("start"), (F.max("start") + LENGTH).alias("end")).drop("at"))
    return spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def passage_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, mark, n_bytes, n_removed, n_spans, spans (array of start, end), kept (bytes left)."""
    least = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                       F.col(text_col).cast("binary").alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    spans = stage(removed_spans(rows, n_bytes).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), "spans"), "passage-spans")
    all_ = rows.join(spans, (F.col("doc_id") == F.col("__id")) & (F.col("mark") == F.col("__mark")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2):
                out = []
                for i, m, text, spans in zip(*(c.to_pylist() for c in part.columns)):
                    text = text or b""
                    a, b = np.array([s["start"] for s in spans or ()], np.int64), np.array([s["end"] for s in spans or ()], np.int64)
                    a, b, _ = merged(np.zeros(len(a), np.int64), a, b)
                    edges = [0, *np.stack([a, b], axis=1).reshape(-1).tolist(), len(text)]
                    kept = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2]))
                    out.append((None if i == least else i, m, len(text), int((b - a).sum()), len(a),
                                [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())], kept))
                cols = [pa.array([r[k] for r in out], t) for k, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "mark", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return all_.select("doc_id", "mark", "text", "spans").mapInArrow(
        cut, "doc_id long, mark long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passage_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
