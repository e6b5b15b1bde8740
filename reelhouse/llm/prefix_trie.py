"""Prefix trie of conversations, its subtree totals by time-forward processing.

Every conversation c is rebuilt: the first h turns of conversation c - c % 100,
then its own turns after its first h, where h is crc32(c) % 6. A node is a
distinct sequence of leading turns, told by its depth and 128 bits of prefix
hash: the sum of one hash for each turn and its place.

1. Places and prefix sums are running sums over rows sorted by range. A task sums
   what it has; what the tasks before it had of the conversation that it begins
   with is added in a second pass. A conversation of any length so spreads over
   tasks. Nodes are then one aggregate over (conversation, depth) rows.
2. A node is named by its smallest member and its depth. On the way down the
   smallest member never falls, so in the order of these names parents come
   before children, and a shard is a range of names: a long path or a wide node
   is split like anything else.
3. In a shard, nodes come in reverse level order from Spark's external sort and
   send their totals to their parents through a priority queue that spills
   sorted runs. Nodes whose parents lie in other shards are shard roots.
4. Across shards: roots of pieces that nothing hangs below are summed up for each
   parent first. The other pieces are a smaller tree, of which the same steps
   give the totals, with shards four times as large on each level. With the
   totals of what hangs below it, a second pass over a shard gives every node.
5. Ids that end at a node are cut into strings in sorted order, by range, and
   only the strings meet in the task that hashes them one after another.

Defined results: turns are ordered by number, null first, then by role, text (by
their first 200 characters, then by hash); a null role or text is empty; rows
that repeat are turns of their own; rows without a conversation id belong to no
conversation and are left out; ``%`` keeps the sign of the id, as in SQL; an
empty table has no root and gives an empty result. Only the four columns are
read. Of a text, its hash and length alone are kept.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import stage, table

#: Conversations that share their first turns, and turns shared at most, plus one.
GROUP, HEADS = 100, 6
#: Nodes to a shard of the first level, at least and about; messages in memory; bytes of a string of ids.
LEAST_SHARD, SHARD_ROWS, QUEUE, STRING = 4096, 1 << 20, 1 << 18, 1 << 20


# --- running sums --------------------------------------------------------------
def _starts(group: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, group[1:] != group[:-1]])


def running(rows: DataFrame, group: str, order: list[str], adds: list[str], name: str) -> DataFrame:
    """``rows`` with ``before_<x>`` and ``upto_<x>`` for each of ``adds``: sums modulo 2**64
    over the rows of the same ``group`` that come earlier, without and with the row.

    (group, order) is unique, so that ranges are even. The driver gets one row a task.
    """
    sums = ", ".join(f"{p}_{a} long" for a in adds for p in ("before", "upto"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + f", {sums}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        last, carry = None, [np.uint64(0)] * len(adds)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column(group).to_numpy()
            start = _starts(g)
            which = np.repeat(np.arange(len(start)), np.diff(np.r_[start, n]))
            new = []
            for k, a in enumerate(adds):
                x = batch.column(a).to_numpy().view(np.uint64)
                total = np.cumsum(x, dtype=np.uint64)
                upto = total - (total[start] - x[start])[which]
                if g[0] == last:
                    upto[which == 0] += carry[k]
                carry[k] = upto[-1]
                new += [pa.array((upto - x).view(np.int64)), pa.array(upto.view(np.int64))]
            last = g[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new, pa.array(np.full(n, part, np.int32)), pa.array(at + np.arange(n))],
                                             [*batch.schema.names, *(f"{p}_{a}" for a in adds for p in ("before", "upto")), "part", "at"])
            at += n

    done = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).mapInArrow(scan, f"{schema}, part int, at long")
    done = stage(done, name)
    ends = done.groupBy("part").agg(F.min_by(group, "at").alias("first"), F.max_by(F.struct(group, *(f"upto_{a}" for a in adds)), "at").alias("last"))
    carried, group_, have = {}, None, [0] * len(adds)
    for r in sorted(ends.collect(), key=lambda r: r["part"]):
        if r["first"] == group_:
            carried[r["part"]] = (group_, list(have))
        here = list(r["last"])
        have = [(h + x) % (1 << 64) for h, x in zip(have, here[1:])] if here[0] == group_ else [x % (1 << 64) for x in here[1:]]
        group_ = here[0]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, g = batch.column("part").to_numpy(), batch.column(group).to_numpy()
            cols = {n: batch.column(n) for n in batch.schema.names if n not in ("part", "at")}
            for p in np.unique(part).tolist():
                if p in carried:
                    mine = (part == p) & (g == carried[p][0])
                    for a, h in zip(adds, carried[p][1]):
                        for c in (f"before_{a}", f"upto_{a}"):
                            x = cols[c].to_numpy().view(np.uint64).copy()
                            x[mine] += np.uint64(h)
                            cols[c] = pa.array(x.view(np.int64))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return done.mapInArrow(add, schema) if carried else done.drop("part", "at")


# --- nodes -----------------------------------------------------------------------
def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, place, x1, x2, chars) of every turn, places from 1."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    turns = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.substring(role, 1, 200).alias("role"), F.substring(text, 1, 200).alias("begin"),
        F.xxhash64(F.lit(1), role, text).alias("x1"), F.xxhash64(F.lit(2), text, role).alias("x2"),
        F.length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("one"),
        F.monotonically_increasing_id().alias("row"))
    order = ["turn", "role", "begin", "x1", "x2", "row"]
    turns = stage(turns, "trie-turns")  # fixes the row numbers
    return running(turns, "conv", order, ["one"], "trie-places").select("conv", F.col("upto_one").alias("place"), "x1", "x2", "chars")


def _paths(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, h1, h2, p1, p2, chars, last): prefix hash of each depth and of the one above; and (conv, length)."""
    heads = turns.where((F.col("place") < HEADS) & (F.col("conv") % GROUP == 0)).select(
        F.col("conv").alias("base"), F.col("place").alias("depth"), "x1", "x2", "chars")
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS, "base": F.col("conv") - F.col("conv") % GROUP})
    have = heads.groupBy("base").agg(F.max("depth").alias("have"))
    convs = convs.join(have, "base", "left").withColumn("k", F.least("h", F.coalesce("have", F.lit(0).cast("long")))).drop("have")
    convs = stage(convs.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))), "trie-conversations")
    taken = convs.join(heads, "base").where(F.col("depth") <= F.col("h")).select("conv", "depth", "x1", "x2", "chars", "length")
    own = turns.join(convs.select("conv", "h", "k", "length"), "conv").where(F.col("place") > F.col("h"))
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "x1", "x2", "chars", "length")
    rows = own.union(taken).select("conv", "depth", "chars", (F.col("depth") == F.col("length")).alias("last"),
                                   F.xxhash64(F.lit(1), "depth", "x1", "x2").alias("h1"), F.xxhash64(F.lit(2), "depth", "x2", "x1").alias("h2"))
    out = running(rows, "conv", ["depth"], ["h1", "h2"], "trie-paths")
    return out.select("conv", "depth", F.col("upto_h1").alias("h1"), F.col("upto_h2").alias("h2"),
                      F.col("before_h1").alias("p1"), F.col("before_h2").alias("p2"), "chars", "last"), convs.select("conv", "length")


NODE = ["depth", "h1", "h2"]


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, h1, h2, ends_sha256) of the nodes at which conversations end."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in (*NODE, "conv")]
            n = batch.num_rows
            new = np.r_[True, np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)] if n else np.empty(0, bool)
            cut = [*np.flatnonzero(new).tolist(), n]
            # Strings of a bounded number of ids, whatever the batch.
            cut = [y for a, b in zip(cut, cut[1:]) for y in range(a, b, STRING // 20)] + [n]
            ids = [str(x).encode() for x in cols[3].tolist()]
            first = np.array(cut[:-1], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(c[first]) for c in cols), pa.array([b",".join(ids[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())],
                                             [*NODE, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        schema = pa.schema([*((c, pa.int64()) for c in NODE), ("ends_sha256", pa.string())])
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if key != node:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(ids)
                else:
                    sha.update(b"," + ids)
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], schema.field(k).type) for k in range(4)], schema=schema)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*node, sha.hexdigest()), schema)], schema=schema)

    cut = ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(strings, "depth long, h1 long, h2 long, first long, ids binary")
    return cut.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "depth long, h1 long, h2 long, ends_sha256 string")


# --- subtree totals ----------------------------------------------------------------
class SpillingQueue:
    """A priority queue of tuples of four integers; what memory does not hold lies in sorted runs on disk."""

    def __init__(self, limit: int):
        self.limit, self.heap = limit, []
        self.heads: list[tuple[tuple, int]] = []
        self.runs: list[Iterator[tuple]] = []

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, item)

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        np.array(sorted(self.heap), dtype=np.int64).tofile(file)
        file.seek(0)

        def items() -> Iterator[tuple]:
            while len(block := np.fromfile(file, np.int64, 4 * 4096)):
                yield from map(tuple, block.reshape(-1, 4).tolist())
            file.close()

        run = items()
        heapq.heappush(self.heads, (next(run), len(self.runs)))
        self.runs.append(run)
        self.heap = []

    def take(self, key: tuple[int, int]) -> tuple[int, int]:
        """Sums of the items for ``key``; all earlier keys are gone."""
        a = b = 0
        while self.heap and self.heap[0][:2] == key:
            item = heapq.heappop(self.heap)
            a, b = a + item[2], b + item[3]
        while self.heads and self.heads[0][0][:2] == key:
            item, k = self.heads[0]
            a, b = a + item[2], b + item[3]
            after = next(self.runs[k], None)
            if after is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (after, k))
        return a, b


def _inside(batch: pa.RecordBatch) -> np.ndarray:
    """Rows whose parent lies in their own shard: it is not before the shard's first name."""
    p, d, f, g = (batch.column(c).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False) for c in ("up_conv", "up_depth", "first_conv", "first_depth"))
    known = np.asarray(batch.column("up_conv").is_valid())
    return known & ((p > f) | ((p == f) & (d >= g)))


def forward(batches: Iterator[pa.RecordBatch], roots: bool) -> Iterator[pa.RecordBatch]:
    """Rows with ``leaves`` and ``saved`` replaced by the totals of their subtrees in the shard;
    ``roots``: of shard roots only. Rows come by shard, in reverse level order."""
    shard, queue = None, SpillingQueue(QUEUE)
    for batch in batches:
        leaves, saved = [], []
        names = batch.schema.names
        for conv, depth, up, up_depth, inside, own, tokens, *of in zip(
                *(batch.column(c).to_pylist() for c in ("conv", "depth", "up_conv", "up_depth")), _inside(batch).tolist(),
                *(batch.column(c).to_pylist() for c in ("leaves", "saved", "first_conv", "first_depth"))):
            if of != shard:
                shard, queue = of, SpillingQueue(QUEUE)
            a, b = queue.take((-depth, -conv))
            a, b = a + own, b + tokens
            if inside:
                queue.push((-up_depth, -up, a, b))
            leaves.append(a)
            saved.append(b)
        new = {"leaves": pa.array(leaves, pa.int64()), "saved": pa.array(saved, pa.int64())}
        out = pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in names], names)
        yield out.filter(pa.array(~_inside(batch))) if roots else out


def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, depth, root_conv, root_depth) of marked rows: the shard root above. Rows come by shard, parents first.

    Nodes of one smallest member lie on one path, so in a shard they have one root.
    """
    shard, root = None, {}
    for batch in batches:
        out = []
        for conv, depth, up, inside, marked, *of in zip(
                *(batch.column(c).to_pylist() for c in ("conv", "depth", "up_conv")), _inside(batch).tolist(),
                *(batch.column(c).to_pylist() for c in ("marked", "first_conv", "first_depth"))):
            if of != shard:
                shard, root = of, {}
            if inside:
                root[conv] = root[up]
            else:
                root[conv] = (conv, depth)
            if marked:
                out.append((conv, depth, *root[conv]))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], ["conv", "depth", "root_conv", "root_depth"])


def _shards(tree: DataFrame, n: int) -> DataFrame:
    """``tree`` cut by range into ``n`` shards, each named by its first node."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for batch in batches:
            if batch.num_rows:
                first = first or (batch.column("conv")[0].as_py(), batch.column("depth")[0].as_py())
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.full(batch.num_rows, x, np.int64)) for x in first)],
                                                 [*batch.schema.names, "first_conv", "first_depth"])

    schema = ", ".join(f"`{c}` {t}" for c, t in tree.dtypes) + ", first_conv long, first_depth long"
    return stage(tree.repartitionByRange(n, "conv", "depth").sortWithinPartitions("conv", "depth").mapInArrow(name, schema), "trie-shards")


def _forwarded(rows: DataFrame, n: int, roots: bool) -> DataFrame:
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    order = rows.repartition(n, "first_conv", "first_depth").sortWithinPartitions("first_conv", "first_depth", F.desc("depth"), F.desc("conv"))
    return order.mapInArrow(lambda b: forward(b, roots), schema).drop("first_conv", "first_depth")


def subtotals(tree: DataFrame, rows: int, size: int | None = None, level: int = 0) -> DataFrame:
    """``tree`` with ``leaves`` and ``saved`` summed over subtrees.

    ``tree`` (staged) has names (conv, depth) and those of the parents (up_conv,
    up_depth; null for none); a parent's name is smaller and its depth less.
    """
    size = size or SHARD_ROWS
    least = int(tree.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, -(-rows // (size << 2 * level)), 0 if level else min(least, rows // LEAST_SHARD))
    cut = _shards(tree, n)
    if n == 1:
        return _forwarded(cut, 1, False)
    inside = (F.col("up_conv") > F.col("first_conv")) | ((F.col("up_conv") == F.col("first_conv")) & (F.col("up_depth") >= F.col("first_depth")))
    keys = ["conv", "depth", "up_conv", "up_depth", "leaves", "saved", "first_conv", "first_depth"]
    marked = cut.where(~inside).select(F.col("up_conv").alias("conv"), F.col("up_depth").alias("depth")).distinct().withColumn("marked", F.lit(True))
    roots = stage(_forwarded(cut.select(*keys), n, True), "trie-roots")
    told = cut.select(*keys).join(stage(marked, "trie-marked"), ["conv", "depth"], "left").withColumn("marked", F.coalesce("marked", F.lit(False)))
    told = told.repartition(n, "first_conv", "first_depth").sortWithinPartitions("first_conv", "first_depth", "conv", "depth")
    told = stage(told.mapInArrow(labels, "conv long, depth long, root_conv long, root_depth long"), "trie-labels")
    inner = told.select(F.col("root_conv").alias("conv"), F.col("root_depth").alias("depth")).distinct()
    # Pieces that nothing hangs below: summed up for each parent.
    summed = [F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")]
    below = roots.where(F.col("up_conv").isNotNull()).join(inner, ["conv", "depth"], "left_anti").groupBy("up_conv", "up_depth").agg(*summed)
    below = stage(below.withColumnsRenamed({"up_conv": "conv", "up_depth": "depth"}), "trie-messages")
    by_root = below.join(told, ["conv", "depth"]).groupBy("root_conv", "root_depth").agg(
        F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
    # The other pieces are a smaller tree.
    above = told.select(F.col("conv").alias("above_conv"), F.col("depth").alias("above_depth"), F.col("root_conv").alias("to_conv"), F.col("root_depth").alias("to_depth"))
    pieces = roots.join(inner, ["conv", "depth"], "left_semi")
    pieces = pieces.join(by_root, (F.col("conv") == F.col("root_conv")) & (F.col("depth") == F.col("root_depth")), "left")
    pieces = pieces.join(above, (F.col("up_conv") == F.col("above_conv")) & (F.col("up_depth") == F.col("above_depth")), "left")
    pieces = stage(pieces.select("conv", "depth", F.col("to_conv").alias("up_conv"), F.col("to_depth").alias("up_depth"),
                                 (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                                 (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                                 F.col("up_conv").alias("at_conv"), F.col("up_depth").alias("at_depth")), "trie-pieces")
    totals = subtotals(pieces, pieces.count(), size, level + 1)
    hung = totals.where(F.col("at_conv").isNotNull()).groupBy(F.col("at_conv").alias("conv"), F.col("at_depth").alias("depth")).agg(*summed)
    more = hung.union(below.select(*hung.columns)).groupBy("conv", "depth").agg(
        F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
    full = cut.join(stage(more, "trie-messages"), ["conv", "depth"], "left").withColumns({
        "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)), "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0))})
    return _forwarded(full.drop("more_leaves", "more_saved"), n, False)


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths, convs = _paths(_turns(rows, conv_col, turn_col, role_col, text_col))
    nodes = paths.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("p1").alias("p1"),
                                     F.max("p2").alias("p2"), F.max("chars").alias("chars"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), "conv", "n_convs", zero.alias("p1"), zero.alias("p2"), zero.alias("chars"))
    nodes = stage(nodes.union(root), "trie-nodes")
    below = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"))
    kids = below.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    ends = paths.where("last").select(*NODE, "conv").union(convs.where("length = 0").select(zero, zero, zero, "conv"))
    ups = nodes.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv").alias("up_conv"))
    tree = nodes.join(kids, NODE, "left").join(ends_digest(ends), NODE, "left").join(ups, ["depth", "p1", "p2"], "left")
    tree = stage(tree.select("conv", "depth", "up_conv", F.when(F.col("depth") > 0, F.col("depth") - 1).alias("up_depth"),
                             F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
                             ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
                             "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                             F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")), "trie")
    done = subtotals(tree, tree.count())
    return done.select(F.col("conv").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children",
                       F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
