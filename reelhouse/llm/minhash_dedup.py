"""Near-duplicate classes by b-bit MinHash.

Texts with the same set of word shingles are one class from the start, so
copies are never compared. A class gets ``BANDS * ROWS`` minima. The bands are
keyed by the full minima; what is kept of them is their low ``BITS`` bits,
packed into longs. Two signatures are compared by counting equal lanes (XOR,
fold, bit count); as unequal minima agree in their low bits once in 2**BITS,
the share of equal lanes is corrected for that. Candidates whose estimate is
out of reach of the threshold (chance below 1e-6) are put aside, all others
are confirmed on the full shingle sets.

Candidates are found in two steps, so that a large group of similar texts is
not compared pair by pair. First every member of a bucket is compared with two
members of it: its hub, which has the most bucket mates over all its bands (in
a family of edited copies, the original), and any other. Confirmed links give
components. Then only bucket mates that are still in different components are
compared, all of them: a link between them is the only kind that can still
change the result. Within a component no pair is generated again. Before that
the shingles of these texts are counted: a pair has no more in common than
either text shares with any other, nor more of the hub than neither misses
(known from the first step as bit maps). These bounds are exact, and rule out
copies that were edited too much without comparing them with their whole family.

Chance to miss a link of similarity 0.8 with 32 bands of 5 rows: 3e-6, and that
pair's documents stay apart only if nothing else connects them.

Defined results: null and empty texts, and texts without words, have an empty
set, link with nothing and are kept; a text with fewer words than a shingle has
its whole sequence as the one shingle; a null id is never the smallest one and
is kept only in a class without any id; of different texts with the same id one
stays; rows that repeat id and text are one document;
an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import only_rows, portions, stage, table, words_of
from reelhouse.llm.components import components

SHINGLE, PERCENT = 5, 80
BANDS, ROWS, BITS = 32, 5, 4
HASHES = BANDS * ROWS
LONGS = HASHES * BITS // 64
#: Longs of a map of missing shingles.
WORDS = 4
#: Word hashes remembered by a worker.
MEMORY = 300_000

_RNG = np.random.default_rng(5)
_MULTIPLY = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KNOWN: dict[bytes, int] = {}


def word_hashes(text: bytes | None) -> np.ndarray:
    words = words_of(text)
    if len(_KNOWN) > MEMORY:
        _KNOWN.clear()
    try:
        return np.fromiter(map(_KNOWN.__getitem__, words), dtype=np.uint64, count=len(words))
    except KeyError:
        for w in words:
            if w not in _KNOWN:
                _KNOWN[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(_KNOWN.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    h = word_hashes(text)
    if not len(h):
        return h
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = (out ^ (out >> np.uint64(32))) * _MIX + h[k:len(h) - width + 1 + k]
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    parts = [(shingles[i:i + 512, None] * _MULTIPLY + _ADD).min(axis=0) for i in range(0, len(shingles), 512)]
    return reduce(np.minimum, parts)


def packed(low: np.ndarray) -> np.ndarray:
    """Low bits of the minima in longs, 64 // BITS lanes each."""
    lanes = (low & np.uint64((1 << BITS) - 1)).reshape(LONGS, 64 // BITS)
    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(lanes << shifts, axis=1).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        key = (key ^ (key >> np.uint64(29))) * _MIX + column
    return (key ^ (key >> np.uint64(32))).view(np.int64)


def set_name(shingles: np.ndarray) -> int:
    """64-bit name of a set; of 10 billion different sets, three pairs may share one."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else 0


def least_equal(percent: int = PERCENT) -> int:
    """Lanes that must agree: a pair at the threshold has fewer with a chance below 1e-6."""
    p = percent / 100 + (1 - percent / 100) / (1 << BITS)
    below = 0.0
    for k in range(HASHES + 1):
        below += comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if below > 1e-6:
            return k
    return HASHES


def equal_lanes(a: list[Column], b: list[Column]) -> Column:
    """Number of equal 4-bit lanes of two packed signatures, by bit counts."""
    ones = F.lit(0x1111111111111111)
    unequal = []
    for x, y in zip(a, b):
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        unequal.append(F.bit_count(d.bitwiseAND(ones)))
    return F.lit(HASHES) - reduce(lambda p, q: p + q, unequal)


def similarity(a: list[Column], b: list[Column]) -> Column:
    """Estimate corrected for chance agreement: (E - 1/2**b) / (1 - 1/2**b)."""
    chance = 1 / (1 << BITS)
    return (equal_lanes(a, b) / HASHES - chance) / (1 - chance)


def described(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, mark, name, n_shingles, sig, bands) of every row of (doc_id, mark, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2):
                names, sizes, sigs, bands = [], [], [], []
                for t in part.column(2).to_pylist():
                    s = shingle_set(t, width)
                    names.append(set_name(s))
                    sizes.append(len(s))
                    low = minima(s) if len(s) else None
                    sigs.append(None if low is None else packed(low))
                    bands.append(None if low is None else band_keys(low))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(sigs, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "mark", "name", "n_shingles", "sig", "bands"])

    return docs.mapInArrow(run, "doc_id long, mark long, name long, n_shingles long, sig array<long>, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class names compared on their full sets, staged.

    Adds linked, both (shingles in common) and, as maps of ``WORDS`` longs,
    which shingles of a that b has not (miss_a), and of b that a has not
    (miss_b): a shingle sets one of the bits, by its hash. ``texts`` (name,
    text) has one whole text per class in question.
    """
    from pyspark.sql.pandas.functions import arrow_udf

    @arrow_udf("struct<linked:boolean,both:long,miss_a:array<long>,miss_b:array<long>>")
    def compared(left: pa.Array, right: pa.Array) -> pa.Array:
        last: tuple = (None, None)
        out = []
        for x, y in zip(left, right):
            y = y.as_py()
            if y != last[0]:
                last = (y, shingle_set(y, width))
            a, b = shingle_set(x.as_py(), width), last[1]
            in_b = b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a
            both = int(in_b.sum())
            in_a = a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b
            out.append({"linked": 100 * both >= percent * (len(a) + len(b) - both), "both": both,
                        "miss_a": bit_map(a[~in_b]), "miss_b": bit_map(b[~in_a])})
        return pa.array(out, pa.struct([("linked", pa.bool_()), ("both", pa.int64()), ("miss_a", pa.list_(pa.int64())), ("miss_b", pa.list_(pa.int64()))]))

    a = texts.select(F.col("name").alias("a"), F.col("text").alias("__ta"))
    b = texts.select(F.col("name").alias("b"), F.col("text").alias("__tb"))
    said = pairs.join(a, "a").join(b, "b").select("a", "b", compared("__ta", "__tb").alias("c"))
    return stage(said.select("a", "b", "c.linked", "c.both", "c.miss_a", "c.miss_b"), "near-compared")


def bit_map(shingles: np.ndarray) -> list[int]:
    out = np.zeros(WORDS * 64, dtype=np.uint8)
    out[(shingles % np.uint64(WORDS * 64)).astype(np.int64)] = 1
    return np.packbits(out).view(np.int64).tolist()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row a document: doc_id, mark (hash of the text), n_shingles,
    component_id, kept (its id is component_id), stays (it stands for its class:
    the same, but for texts that share an id)."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                       F.col(text_col).cast("binary").alias("text"))
    rows = stage(described(slim, width), "near-rows")
    filled = rows.where("n_shingles > 0")
    # The first row of a class stands for it; struct order puts a null id first,
    # so ids are ordered with nulls as the greatest.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("row")
    sets = stage(filled.groupBy("name").agg(first, F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
                 .select("name", "row.doc_id", "row.mark", "n", "sig", "bands"), "near-sets")
    members = stage(sets.select("name", F.explode("bands").alias("band")), "near-members")

    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    busy = stage(members.join(stage(sizes, "near-sizes"), "band"), "near-busy")
    weight = stage(busy.groupBy("name").agg(F.sum("mates").alias("weight")), "near-weights")
    ends = stage(busy.join(weight, "name").groupBy("band").agg(F.max(F.struct("weight", "name")).alias("hub"), F.min("name").alias("lo")), "near-ends")
    stars = busy.join(ends, "band").select(F.col("name").alias("a"), F.explode(F.array("hub.name", "lo")).alias("b")).where("a != b")
    pairs = _alike(sets, _ordered(stars).distinct(), percent)
    seen = confirmed(pairs, _texts(slim, sets, _nodes(pairs)), width, percent)
    links = seen.where("linked").select("a", "b")

    labels = components(links)
    # Bucket mates that the first step left in different components.
    at = busy.select("name", "band").join(labels.withColumnRenamed("node", "name"), "name", "left")
    at = stage(at.withColumn("label", F.coalesce("label", "name")), "near-at")
    mixed = at.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("band")
    left = stage(at.join(stage(mixed, "near-mixed"), "band").join(ends.select("band", F.col("hub.name").alias("hub")), "band"), "near-left")
    texts = _texts(slim, sets, left.select(F.explode(F.array("name", "hub")).alias("name")).distinct())
    shared = stage(_shared(texts, width), "near-shared")
    sigs = sets.select("name", "n", *[F.col("sig")[i].alias(f"s{i}") for i in range(LONGS)]).join(shared, "name")
    # What is known of a member and the hub of its bucket.
    to_hub = lambda name, hub, miss: seen.select(F.col(name).alias("name"), F.col(hub).alias("hub"), "both", F.col(miss).alias("miss"))
    hubs = stage(to_hub("a", "b", "miss_b").union(to_hub("b", "a", "miss_a")), "near-hubs")
    wide = left.join(hubs, ["name", "hub"], "left").join(stage(sigs, "near-sigs"), "name")
    of_hub = sets.select(F.col("name").alias("hub"), F.col("n").alias("hub_n"))
    wide = stage(wide.join(of_hub, "hub").withColumns({
        "both": F.when(F.col("name") == F.col("hub"), F.col("n")).otherwise(F.col("both")),
        "miss": F.when(F.col("name") == F.col("hub"), F.array(*[F.lit(0).cast("long")] * WORDS)).otherwise(F.col("miss"))}), "near-wide")
    x = wide.toDF(*[f"x_{c}" for c in wide.columns])
    y = wide.toDF(*[f"y_{c}" for c in wide.columns])
    near = _near(F.col("x_n"), F.col("y_n"), [F.col(f"x_s{i}") for i in range(LONGS)], [F.col(f"y_s{i}") for i in range(LONGS)], percent)
    # Bounds of what a pair has in common: the lesser ``shared``; and what of the
    # hub neither misses, with what either shares beyond the hub.
    missed = reduce(lambda p, q: p + q, [F.bit_count(F.col("x_miss")[i].bitwiseOR(F.col("y_miss")[i])) for i in range(WORDS)])
    beyond = F.least(F.col("x_shared") - F.col("x_both"), F.col("y_shared") - F.col("y_both"))
    least_shared = F.least("x_shared", "y_shared")
    most = F.least(least_shared, F.coalesce(F.col("x_hub_n") - missed + beyond, least_shared))
    # Linked means 100 * both >= percent * (n + m - both).
    reach = (100 + percent) * most >= percent * (F.col("x_n") + F.col("y_n"))
    rest = (x.join(y, (F.col("x_band") == F.col("y_band")) & (F.col("x_label") < F.col("y_label")) & reach & near)
            .select(F.col("x_name").alias("a"), F.col("y_name").alias("b")))
    more = confirmed(stage(_ordered(rest).distinct(), "near-pairs"), texts, width, percent).where("linked").select("a", "b")
    if not more.isEmpty():
        labels = components(stage(links.union(more), "near-links"))

    # The head of a component is its first row, by id (none is last) and mark.
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    named = sets.select("name", row.alias("row")).join(labels.withColumnRenamed("node", "name"), "name", "left")
    named = stage(named.select("name", "row", F.coalesce("label", "name").alias("label")), "near-named")
    heads = stage(named.groupBy("label").agg(F.min("row").alias("head")), "near-heads")
    heads = stage(named.select("label", "name").join(heads, "label").select("name", "head"), "near-heads")
    out = filled.select("doc_id", "mark", "n_shingles", "name").join(heads, "name").select(
        "doc_id", "mark", "n_shingles", F.col("head.doc_id").alias("component_id"), F.col("head.mark").alias("head_mark"))
    alone = rows.where("n_shingles = 0").select("doc_id", "mark", "n_shingles", F.col("doc_id").alias("component_id"), F.col("mark").alias("head_mark"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.union(alone).withColumn("kept", kept).withColumn("stays", kept & (F.col("mark") == F.col("head_mark"))).drop("head_mark")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, all columns kept."""
    classes = near_classes(docs, id_col, text_col, width, percent).where("stays")
    return only_rows(docs, classes, id_col, text_col)


def _near(n: Column, m: Column, a: list[Column], b: list[Column], percent: int) -> Column:
    """Sizes allow the similarity, and the estimate is not out of reach of it."""
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (equal_lanes(a, b) >= least_equal(percent))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _alike(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Staged candidate pairs whose estimate is not out of reach."""
    pairs = stage(pairs, "near-pairs")
    sig = lambda p: sets.select(F.col("name").alias(p), F.col("n").alias(f"__n{p}"), F.col("sig").alias(f"__{p}"))
    lanes = lambda p: [F.col(f"__{p}")[i] for i in range(LONGS)]
    near = _near(F.col("__na"), F.col("__nb"), lanes("a"), lanes("b"), percent)
    return stage(pairs.join(sig("a"), "a").join(sig("b"), "b").where(near).select("a", "b"), "near-pairs")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()


def _texts(slim: DataFrame, sets: DataFrame, names: DataFrame) -> DataFrame:
    """Staged (name, text): a whole text of each of the named classes."""
    asked = names.join(sets.select("name", "doc_id", "mark"), "name")
    asked = stage(asked.withColumnsRenamed({"doc_id": "__id", "mark": "__mark"}), "near-asked")
    same = (F.col("mark") == F.col("__mark")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    # What is asked for grows with the corpus, so it is not to be broadcast.
    # Repeated rows have the same text: any of them does.
    texts = slim.join(asked.hint("merge"), same).groupBy("mark", "doc_id").agg(F.first("name").alias("name"), F.first("text").alias("text"))
    return stage(texts.select("name", "text"), "near-texts")


def _shared(texts: DataFrame, width: int) -> DataFrame:
    """(name, shared): shingles of a class that any other of ``texts`` has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 1, 2 << 20):
                sets = [shingle_set(t, width) for t in part.column(1).to_pylist()]
                names = np.repeat(part.column(0).to_numpy(), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.concatenate(sets).view(np.int64))], ["name", "shingle"])

    each = texts.mapInArrow(run, "name long, shingle long")
    of = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"))
    alone = of.where("n = 1").groupBy("name").agg(F.count(F.lit(1)).alias("alone"))
    every = each.groupBy("name").agg(F.count(F.lit(1)).alias("all"))
    return every.join(alone, "name", "left").select("name", (F.col("all") - F.coalesce("alone", F.lit(0))).alias("shared"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"), width=2).drop("mark", "stays")
