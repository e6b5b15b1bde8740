"""The draw of slots per shard, and columns with the operators' own names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelhouse.llm import minhash_dedup, mixing, sharding


@pytest.mark.parametrize("n, size, take", [(3, 40, 20), (37, 40, 20), (20, 40, 37), (5, 5, 3), (0, 9, 4), (4, 9, 9), (9, 9, 4),
                                           (900, 3000, 1500), (65, 100_000, 50_000), (2_999, 3000, 10), (1, 2, 1)])
def test_hypergeometric_draws(spark, n, size, take):
    draws = 4000
    x = mixing.drawn(*[F.lit(v).cast("long") for v in (n, size, take)], F.col("id"))
    row = spark.range(draws).select(x.alias("x")).agg(F.avg("x"), F.var_samp("x"), F.min("x"), F.max("x")).first()
    mean, spread = take * n / size, take * n / size * (size - n) / size * (size - take) / max(1, size - 1)
    assert abs(row[0] - mean) <= 4 * (spread / draws) ** 0.5 + 1e-9
    assert abs(row[1] - spread) <= 0.15 * spread + 1e-9
    assert max(0, take - (size - n)) <= row[2] and row[3] <= min(n, take)


def test_shards_split_the_totals(spark):
    totals, chunk = [5000, 0, 900, 61, 1], 64
    got = mixing.drawn_shards(spark, totals, chunk).collect()
    size, by_source = Counter(), {s: [] for s in range(5)}
    for r in got:
        size[r.shard] += r.n
        by_source[r.sid].append((r.shard, r["from"], r.n))
    shards = -(-sum(totals) // chunk)
    assert size == {s: chunk if s < shards - 1 else sum(totals) - chunk * (shards - 1) for s in range(shards)}
    for s, rows in by_source.items():  # numbered without gaps, in the order of the shards
        at = 0
        for _, first, n in sorted(rows):
            assert first == at
            at += n
        assert at == totals[s]
    # The mean and spread of a multinomial, conditioned on its totals.
    of = dict((shard, n) for shard, _, n in by_source[0])
    counts = [of.get(s, 0) for s in range(shards - 1)]
    p = totals[0] / sum(totals)
    mean, var = sum(counts) / len(counts), sum((c - chunk * p) ** 2 for c in counts) / len(counts)
    assert abs(mean - chunk * p) < 1 and 0.5 * chunk * p * (1 - p) < var < 2 * chunk * p * (1 - p)
    assert mixing.drawn_shards(spark, [0, 0], chunk).count() == 0 and mixing.drawn_shards(spark, [], chunk).count() == 0


def test_every_slot_has_one_block(spark):
    plan = mixing.plan_sources(spark, [("a", 2000), ("b", 301), (None, 1)], 16)
    blocks = spark.createDataFrame([(p["sid"], b) for p in plan for b in range(p["blocks"])], "sid bigint, block bigint")
    got = mixing.block_slots(spark, blocks, plan, 16, 8).collect()
    drawn = {(r.sid, r.shard): r.n for r in mixing.drawn_shards(spark, [p["slots"] for p in plan], 8).collect()}
    assert Counter((r.sid, r.shard) for r in got) == drawn
    for p in plan:
        mine = Counter(r.block for r in got if r.sid == p["sid"])
        assert sum(mine.values()) == p["slots"] and max(mine.values()) - min([mine[b] for b in range(p["blocks"])]) <= 1
        assert abs(sum(r.length for r in got if r.sid == p["sid"]) - p["target"]) <= 1


def test_shards_follow_their_length(spark):
    rows = [(i, "w " * (5 + 400 * (i % 97 == 0)), "abc"[min(i % 5, 2)]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {n: {r.doc_id: r for r in mixing.mix(docs, block=16, shard_slots=n).collect()} for n in (8, 64, 10 ** 6)}
    for small, large in ((8, 64), (64, 10 ** 6)):
        assert {i: r.taken for i, r in got[small].items()} == {i: r.taken for i, r in got[large].items()}
        assert sum(r.n_shards for r in got[small].values()) > sum(r.n_shards for r in got[large].values())
    for r in got[10 ** 6].values():
        assert (r.n_shards, r.first_shard) == ((1, 0) if r.taken else (0, None))
    assert len({r.first_shard for r in got[8].values()}) > 50


CLASH = "doc_id long, text string, source string, __key string, __mark string, __id int, __times int, Shard string, SLOT int, c0 string, `a.b` string, __hs_h string"


@pytest.fixture()
def clash(spark):
    rows = [(i, f"w{i % 9} " * 30 + f"x{i} " * 20, "ab"[i % 2], f"k{i}", f"m{i}", i, 2 * i, f"s{i}", 3 * i, f"c{i}", f"d{i}", f"h{i}") for i in range(60)]
    return spark.createDataFrame(rows, CLASH), {tuple(r) for r in rows}


def test_mixed_keeps_columns_of_any_name(clash):
    docs, rows = clash
    out = mixing.mixed(docs, block=16, shard_slots=8)
    assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= rows


def test_near_dedup_keeps_columns_of_any_name(clash):
    docs, rows = clash
    out = minhash_dedup.near_dedup(docs)
    assert out.schema.simpleString() == docs.schema.simpleString() and {tuple(r) for r in out.collect()} == rows


def test_shard_keeps_columns_of_any_name(spark, clash, tmp_path):
    docs, rows = clash
    out = sharding.histogram_shard(docs, shards=4)
    assert out.columns == [c for c in docs.columns if c not in ("Shard", "SLOT")] + ["shard", "slot"]
    out.write.parquet(str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {tuple(r)[:-2] for r in got.collect()} == {r[:7] + r[9:] for r in rows}


def test_ranges_follow_the_bytes(spark, monkeypatch):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    keyed = sharding._keys(docs, "doc_id", "text", 0)
    shifts = sharding._shifts(0, 4000)
    want = {tuple(r) for r in sharding.histogram_shard(docs, shards=4).collect()}
    few = len(sharding.split_ranges(keyed, shifts, 4, 0.01))
    monkeypatch.setattr(sharding, "RANGE_ROWS", 1)
    monkeypatch.setattr(sharding, "LEAVES", 8)
    monkeypatch.setattr(sharding, "RANGE_BYTES", 10)  # fewer than a text has: a range for each row
    ranges = sharding.split_ranges(keyed, shifts, 4, 0.01)
    assert len(ranges) == 4000 > few and {r.rows for r in ranges} == {1}
    monkeypatch.setattr(sharding, "FEW_RANGES", 10)  # joined without a broadcast
    assert {tuple(r)[:3] for r in sharding.histogram_shard(docs, shards=4).collect()} == {r[:3] for r in want}
