"""Mixing sources to target weights.

The words of each source are laid end to end and cut into blocks of fixed
length (the last is shorter). The mix is a row of output shards of a fixed
number of slots. For each shard the slots' sources are drawn: a multinomial
draw, conditioned on the totals, so that every source meets its target and not
only its expectation. It is made by a pseudorandom permutation of all slots of
the mix, of which shard and source see an unordered sample each. The counts per
shard and source, added up over the shards, number the slots of a source; a
pseudorandom permutation of the source's blocks, another one for each pass over
the source, maps slot numbers to blocks, and blocks are joined by their index.

Permutations are swap-or-not networks: they permute any range exactly, run the
same forwards and backwards, and need no table. All seeds are fixed: reruns
agree, and a retried task gives what it gave before.

Skew: no step works on all rows of a source. Word offsets are sums within bins
of a source plus sums over the bins before; blocks are keyed by (source, block).
The driver holds one row per source.

Defined results: a null text has no words; null is a source of its own, last in
order; documents without words take none; repeated rows are documents of their
own; an empty table, or one without a word, gives zeros. Only id, text and
source are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import WORD, flat, row_keys, small_frame, stage, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 128
SHARD_SLOTS = 4096
#: Documents to a bin when offsets are added up.
BIN_ROWS = 1024
#: Draws of an urn that are made one by one; nodes of the tree to a task; blocks to a task.
URN, TASK_NODES, TASK_BLOCKS = 64, 4096, 50_000
#: Up to so many sources (half a megabyte), the table of them is broadcast.
FEW_SOURCES = 10_000
ROUNDS = 24
SEED = 8


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Share of each source, none above ``most`` times its size."""
    out = [0.0] * len(sizes)
    left, free = share * sum(sizes), set(range(len(sizes)))
    while free:
        whole = sum(weights[i % len(weights)] for i in free)
        want = {i: left * weights[i % len(weights)] / whole for i in free}
        full = {i for i in free if want[i] > most * sizes[i]}
        for i in full or free:
            out[i] = float(most * sizes[i]) if full else want[i]
        if not full:
            break
        left -= sum(out[i] for i in full)
        free -= full
    return out


def permuted(x: Column, n: Column, *key: Column, back: bool = False) -> Column:
    """Pseudorandom permutation of 0..n-1 chosen by ``key``; ``back`` inverts it."""

    def turn(v: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), r, *key), n) + n - v, n)
        swap = F.xxhash64(F.lit(SEED + 1), r, *key, F.greatest(v, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(v)

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, x, turn)


def laid_out(slim: DataFrame, n_rows: int) -> DataFrame:
    """``slim`` (.., sid, size, mark) with ``off``: words of its source before it."""
    bins = slim.withColumn("bin", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(max(1, -(-n_rows // BIN_ROWS)))))
    sums = bins.groupBy("sid", "bin").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("sid").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("sid", "bin", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("sid", "bin").orderBy("doc_id", "mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (bins.withColumn("off", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(starts, ["sid", "bin"]).withColumn("off", F.col("off") + F.col("start")).drop("bin", "start"))


def plan_sources(spark: SparkSession, found: list[tuple], block: int) -> list[dict]:
    """Targets and slot counts; ``found`` has (source, words), one row a source."""
    order = sorted(found, key=lambda r: (r[0] is None, r[0] or ""))
    plan = [{"sid": i, "source": s, "words": w, "target": t, "blocks": -(-w // block), "slots": 0, "cut": 0}
            for i, ((s, w), t) in enumerate(zip(order, targets([w for _, w in order])))]
    live = [p for p in plan if p["words"]]
    if live:
        # Where the short last block stands in each of the passes.
        frame = small_frame(spark, [(p["sid"], p["blocks"]) for p in live], "sid bigint, blocks bigint")
        last = F.col("blocks") - 1
        tails = {r["sid"]: r["tails"] for r in frame.select("sid", F.array(*[
            permuted(last, F.col("blocks"), F.col("sid"), F.lit(q).cast("long"), back=True) + q * F.col("blocks")
            for q in range(int(MOST))]).alias("tails")).collect()}
        for p in live:
            short, want = p["blocks"] * block - p["words"], round(p["target"])
            slots = -(-want // block)
            for at in sorted(tails[p["sid"]]):
                if at < slots:
                    want += short
                    slots = -(-want // block)
            p["slots"] = min(slots, int(MOST) * p["blocks"])
            p["cut"] = max(0, p["slots"] * block - want)
    return plan


def _uniform(*key: Column) -> Column:
    """Between 0 and 1, both left out."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 3), *key), 12).cast("double") + 0.5) / float(1 << 52)


def drawn(n: Column, size: Column, take: Column, *key: Column) -> Column:
    """How many of ``take`` items out of ``size`` are among its ``n`` marked ones: a hypergeometric draw."""
    mean = take * n / size
    spread = F.sqrt(mean * (size - n) / size * (size - take) / F.greatest(size - 1, F.lit(1)))
    normal = F.sqrt(-2 * F.log(_uniform(*key, F.lit(-1)))) * F.cos(2 * math.pi * _uniform(*key, F.lit(-2)))
    most, least = F.least(n, take), F.greatest(F.lit(0).cast("long"), take - (size - n))
    limit = F.greatest(least, F.least(most, F.round(mean + spread * normal).cast("long")))
    # An urn gives the same with marked and taken, or items and the others, in each other's place: the least of four numbers is drawn.
    few = F.least(n, take, size - n, size - take)
    swap = F.least(size - n, size - take) < F.least(n, take)
    marked = F.when(swap, F.greatest(size - n, size - take)).otherwise(F.greatest(n, take))
    step = lambda a, t: F.struct(
        (a["left"] - 1).alias("left"), (a["marked"] - (_uniform(*key, t) * a["left"] < a["marked"]).cast("long")).alias("marked"))
    hits = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1), F.least(few, F.lit(URN))).cast("long")), F.struct(size.alias("left"), marked.alias("marked")), step,
                       lambda a: marked - a["marked"])
    # Not marked and not taken: size - n - take of them more than those marked and taken.
    exact = F.when(swap, hits - (size - n - take)).otherwise(hits)
    return F.when(few <= 0, least).when(few <= URN, exact).otherwise(limit)


def split_node(counts: Column, take: Column, *key: Column) -> Column:
    """Of a node's slots by source, those of its left part, which has ``take`` slots."""
    start = F.struct(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x).alias("size"), take.alias("take"), F.array().cast("array<bigint>").alias("out"))

    def one(a: Column, s: Column) -> Column:
        n = F.get(counts, s)
        x = F.when((n > 0) & (a["take"] > 0), drawn(n, a["size"], a["take"], *key, s)).otherwise(F.lit(0).cast("long"))
        return F.struct((a["size"] - n).alias("size"), (a["take"] - x).alias("take"), F.concat(a["out"], F.array(x)).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.size(counts) - 1), start, one, lambda a: a["out"])


def drawn_shards(spark: SparkSession, totals: list[int], shard_slots: int) -> DataFrame:
    """(shard, sid, from, n): each shard's slots of a source are ``from`` to ``from + n - 1`` of it. Shards have
    ``shard_slots`` slots, the last one what is left; staged."""
    shards = -(-sum(totals) // shard_slots)
    tree = small_frame(spark, [(0, shards, list(totals), [0] * len(totals))], "first bigint, n bigint, counts array<bigint>, before array<bigint>").where("n > 0")
    for level in range(max(0, shards - 1).bit_length()):
        half = F.expr("(n + 1) div 2")
        tree = tree.withColumn("left", F.when(F.col("n") > 1, split_node(F.col("counts"), half * shard_slots, F.col("first"), F.col("n"))))
        sides = F.array(
            F.struct(F.col("first"), half.alias("n"), F.col("left").alias("counts"), F.col("before")),
            F.struct((F.col("first") + half).alias("first"), (F.col("n") - half).alias("n"), F.zip_with("counts", "left", lambda c, x: c - x).alias("counts"),
                     F.zip_with("before", "left", lambda b, x: b + x).alias("before")))
        self_ = F.array(F.struct("first", "n", "counts", "before"))
        tree = tree.select(F.explode(F.when(F.col("n") > 1, sides).otherwise(self_)).alias("t")).select("t.*")
        if level % 8 == 7:
            # A node stands for thousands of slots: the number of tasks follows the shards.
            tree = stage(tree.repartition(max(8, -(-shards // TASK_NODES)), "first"), "mix-tree")
    each = F.explode(F.transform(F.sequence(F.lit(0), F.size("counts") - 1), lambda s: F.struct(
        s.cast("long").alias("sid"), F.get("before", s).alias("from"), F.get("counts", s).alias("n"))))
    return stage(tree.select(F.col("first").alias("shard"), each.alias("s")).select("shard", "s.*").where("n > 0"), "mix-shards")


def block_slots(spark: SparkSession, pieces: DataFrame, plan: list[dict], block: int, shard_slots: int) -> DataFrame:
    """``pieces`` (sid, block, ..) with each slot that takes their block: ``shard``, and ``length``, the words of the block that it takes."""
    total = sum(p["slots"] for p in plan)
    # Slots of a source that a shard is expected to have.
    rows = [(p["sid"], p["slots"], p["blocks"], p["words"], p["cut"], max(1, p["slots"] * shard_slots // max(1, total))) for p in plan if p["slots"]]
    sources = small_frame(spark, rows, "sid bigint, slots bigint, blocks bigint, words bigint, cut bigint, stretch bigint")
    if len(rows) <= FEW_SOURCES:
        sources = F.broadcast(sources)
    shards = drawn_shards(spark, [p["slots"] for p in plan], shard_slots).join(sources, "sid")
    shards = shards.select("shard", "sid", "from", "n", F.explode(F.sequence(F.expr("`from` div stretch"), F.expr("(`from` + n - 1) div stretch"))).alias("at"))
    pass_ = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(slots - 1) div blocks")))
    slots = pieces.join(sources, "sid").withColumn("pass", pass_)
    slots = slots.withColumn("i", F.col("pass") * F.col("blocks") + permuted(F.col("block"), F.col("blocks"), F.col("sid"), F.col("pass"), back=True))
    slots = slots.where("i < slots").withColumn("at", F.expr("i div stretch"))
    length = F.least(F.lit(block).cast("long"), F.col("words") - F.col("block") * block)
    is_cut = (F.col("i") == F.col("slots") - 1) & (F.col("cut") > 0)
    slots = slots.withColumn("length", F.when(is_cut, F.greatest(length - F.col("cut"), F.lit(0))).otherwise(length))
    inside = slots.join(shards, ["sid", "at"]).where("i >= `from` AND i < `from` + n")
    return inside.select(*pieces.columns, "shard", "length")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken, mark, n_shards, first_shard.

    ``mark`` is the hash of the text: with doc_id it names the document. ``n_shards``
    is the number of shards that words of it go to, ``first_shard`` the least (null: none).
    """
    spark = docs.sparkSession
    slim = stage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text_col).alias("mark"),
    ), "mix-documents")
    found = slim.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).collect()
    plan = plan_sources(spark, [(r["source"], r["words"]) for r in found], block)
    sources = small_frame(spark, [(p["sid"], p["source"], p["words"], p["target"]) for p in plan],
                          "sid bigint, of string, source_size bigint, target double")
    known = slim.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")
    spread = stage(laid_out(known, sum(r["n"] for r in found)), "mix-offsets")
    b = F.col("block") * block
    # A row stands for up to thousands of blocks: the number of tasks follows the blocks.
    texts = spread.where("size > 0").select("sid", "off", "size").repartition(-(-sum(p["blocks"] for p in plan) // TASK_BLOCKS) or 1, "sid", "off")
    pieces = texts.select("sid", "off", "size", F.explode(F.sequence(
        F.expr(f"off div {block}"), F.expr(f"(off + size - 1) div {block}"))).alias("block"))
    takes = block_slots(spark, pieces, plan, block, shard_slots)
    words = F.least(F.col("off") + F.col("size"), b + F.col("length")) - F.greatest("off", b)
    # First by shard, so that a document of many blocks is not one set of shards in memory.
    by_shard = takes.where(words > 0).groupBy("sid", "off", "size", "shard").agg(F.sum(words).cast("long").alias("words"))
    taken = by_shard.groupBy("sid", "off", "size").agg(F.sum("words").alias("taken"), F.count(F.lit(1)).alias("n_shards"), F.min("shard").alias("first_shard"))
    zero = F.lit(0).cast("long")
    return (spread.join(taken, ["sid", "off", "size"], "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"), "mark", F.coalesce("n_shards", zero).alias("n_shards"), "first_shard"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **size) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes their words, all columns kept;
    rows that it does not take are left out. What is over a whole number of times
    is the chance of one time more, drawn by a hash of the row: rounded to the
    nearest, the long documents of a source would all go the same way."""
    draw = F.pmod(F.xxhash64(F.lit(SEED + 2), "__key", "__mark"), F.lit(1 << 30)) / float(1 << 30)
    times = F.floor(F.col("__times") + draw).cast("int")
    plan = (mix(docs, id_col, text_col, source_col, **size).where("size > 0")
            .groupBy(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("__key"), F.col("mark").alias("__mark"))
            .agg((F.avg("taken") / F.max("size")).alias("__times")).withColumn("__times", times))
    plan = stage(plan.where("__times > 0"), "mix-times")
    rows, back, (id_, text) = flat(docs, id_col, text_col)
    return (row_keys(rows, id_, text).join(plan, ["__key", "__mark"])
            .withColumn("__time", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*back))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("mark")
