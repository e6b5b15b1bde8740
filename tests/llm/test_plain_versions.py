"""The registered mix, shards and near copies against plain versions over whole tables."""

import re
import struct
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import pytest
import xxhash

import __spark_entry__
import corpus_pipeline
from reelhouse.llm import mixing, sharding
from reelhouse.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def hashed(*values):
    """Spark's xxhash64: (kind, value) one after the other, each with the hash so far as seed; nulls are left out."""
    seed = 42
    for kind, x in values:
        if x is not None:
            seed = xxhash.xxh64_intdigest(x.encode() if kind == "s" else struct.pack("<" + kind, x), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def permuted(x, n, *key):
    """Swap-or-not, forwards."""
    for r in range(1, mixing.ROUNDS + 1):
        other = (hashed(("i", mixing.SEED), ("i", r), *key) % n + n - x) % n
        if hashed(("i", mixing.SEED + 1), ("i", r), *key, ("q", max(x, other))) & 1:
            x = other
    return x


def shares(sizes):
    """150 % of all by weights 3, 1, 2, none above twice its size."""
    fixed = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left, weight = 1.5 * sum(sizes) - sum(fixed.values()), sum((3, 1, 2)[i % 3] for i in free)
        want = {i: left * (3, 1, 2)[i % 3] / weight for i in free}
        over = {i: 2.0 * sizes[i] for i in free if want[i] > 2 * sizes[i]}
        if not over:
            return [fixed.get(i, want.get(i)) for i in range(len(sizes))]
        fixed |= over


def plain_mix(rows, block):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source): every slot is filled, word by word."""
    mark = lambda t: hashed(("s", t))
    bins = max(1, -(-len(rows) // mixing.BIN_ROWS))
    by_source = defaultdict(list)
    for i, text, source in rows:
        at = hashed(("q", i), ("q", mark(text))) % bins
        by_source[source].append((at, i is not None, i or 0, mark(text), len(WORD.findall(text or ""))))
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(d[-1] for d in by_source[s]) for s in order]
    out = []
    for sid, (source, words, target) in enumerate(zip(order, sizes, shares(sizes))):
        docs = sorted(by_source[source])
        owner = [k for k, d in enumerate(docs) for _ in range(d[-1])]
        blocks, taken, left, slot = -(-words // block), Counter(), round(target), 0
        while left > 0 and slot < 2 * blocks:
            b = permuted(slot % blocks, blocks, ("q", sid), ("q", slot // blocks))
            part = owner[b * block:(b + 1) * block][:left]
            taken.update(part)
            left -= len(part)
            slot += 1
        out += [(d[2] if d[1] else None, d[-1], words, target, taken[k]) for k, d in enumerate(docs)]
    return out


def rows_of(columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/documents.parquet'").fetchall()


def same(got, want):
    close = lambda rows: Counter((*r[:3], round(r[3], 6), r[4]) for r in rows)
    assert close(got) == close(want)


def test_mix_of_documents(spark):
    got = __spark_entry__.queries()["op8_source_mix"](spark, SF).select("doc_id", "size", "source_size", "target", "taken").collect()
    same(got, plain_mix(rows_of("doc_id, text, source"), mixing.BLOCK))


@pytest.mark.parametrize("block", [1, 7, 64])
def test_mix_of_short_and_empty_sources(spark, block):
    rows = [(i, "w " * (i * 7 % 23), "ab"[i % 2]) for i in range(90)]
    rows += [(200, "one", None), (201, None, "c"), (202, "", "c"), (203, "x y z", "d"), (None, "p q", "d"), (204, "w " * 900, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block=block, shard_slots=8).select("doc_id", "size", "source_size", "target", "taken").collect()
    same(got, plain_mix(rows, block))


def test_shards_of_documents(spark):
    """Rows in the order of (hash of the text, id), cut where the bytes are even, numbered within each shard."""
    rows = sorted((hashed(("s", t or "")), i, len((t or "").encode()) + 1) for i, t in rows_of("doc_id, text"))
    got = {r.doc_id: r for r in __spark_entry__.queries()["op4_histogram_sort"](spark, SF).collect()}
    assert len(got) == len(rows)
    below, at, slot, total = 0, 0, 0, sum(r[2] for r in rows)
    largest = max(r[2] for r in rows)
    for _, i, size in rows:
        r = got[i]
        if r.shard != at:
            assert r.shard == at + 1 and abs(below - total * r.shard / 16) <= max(largest, sharding.TOLERANCE * total / 16)
            at, slot = r.shard, 0
        assert (r.size, r["slot"]) == (size, slot)
        below, slot = below + size, slot + 1
    assert at == 15


def test_near_copies_of_documents(spark):
    """The pipeline's second stage keeps the least id of each component of all pairs with similarity 0.8, five words."""
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    sets, home = {}, {}
    for i, t in rows_of("doc_id, text"):
        w = WORD.findall(low(t))
        k = min(5, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
        home[i] = i

    def head(i):
        while home[i] != i:
            i = home[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= 80 * (len(x) + len(y) - both):
                a, b = sorted((head(a), head(b)))
                home[b] = a
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = stage(spark, table(spark, SF, "documents"), SF)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(i for i in home if home[i] == i)
