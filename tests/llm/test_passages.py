"""Blocks and shards of the passage removal."""

import time

import numpy as np
import xxhash

from reelhouse.llm import suffix_dedup as sd


def block(n=400, seed=1):
    rng = np.random.default_rng(seed)
    shared = bytes(rng.integers(97, 123, 300).astype(np.uint8))
    texts = [bytes(rng.integers(97, 123, 500).astype(np.uint8)) + shared * (i % 3 == 0) for i in range(n)]
    return np.arange(n), np.arange(n) + 7, texts


def parts_of(shards, **given):
    """(holders, repeats) by shard."""
    return {s: read(d) for s, d in sd.block_parts(*block(**given), shards)}


def read(data):
    holders, repeats = sd.unpack(data)
    return holders.view(sd.HOLDER), repeats.view(sd.REPEAT)


def test_a_block_costs_the_same_for_any_number_of_shards():
    took = {}
    for shards in (8, 1000, 10_000):
        parts_of(shards)
        given = block()
        start = time.process_time()
        list(sd.block_parts(*given, shards))
        took[shards] = time.process_time() - start
        got, (whole, own) = parts_of(shards), parts_of(1)[0]
        assert all((h["h"] % np.uint64(shards) == s).all() for s, (h, _) in got.items())
        assert sorted(x.tobytes() for h, _ in got.values() for x in h) == sorted(x.tobytes() for x in whole)
        assert [r.tobytes() for _, r in got.values() if len(r)] == [own.tobytes()]
    assert took[10_000] < 5 * took[8] + 0.5
    print(took)


def test_regions_of_equal_hash_are_confirmed(monkeypatch):
    """With a hash that is the same for all regions, no bytes go that are not repeated."""
    texts = block(40)[2] + block(40)[2][:5]
    ids, marks = np.arange(len(texts)), np.array([xxhash.xxh64_intdigest(t) >> 1 for t in texts])

    def spans(shards=3, blocks=1):
        data = {}
        for k in range(blocks):
            some = slice(k, None, blocks)
            for s, d in sd.block_parts(ids[some], marks[some], texts[some], shards):
                data.setdefault(s, []).append(d)
        out = {}
        for d in data.values():
            for r in sd.decided(d).to_pylist():
                if r["anchor"] is None:
                    out.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
        return out

    want, apart = spans(), spans(blocks=4)
    assert want and want == apart
    real = xxhash.xxh3_128_digest
    monkeypatch.setattr(sd.xxhash, "xxh3_128_digest", lambda data, seed: bytes(8) + real(data, seed)[8:])
    assert spans(blocks=4) == want  # by the second hash between blocks
    monkeypatch.setattr(sd.xxhash, "xxh3_128_digest", lambda data, seed: bytes(16))
    own = [read(d) for _, d in sd.block_parts(ids, marks, texts, 1)][0][1]
    for i, _, a, b in own.tolist():  # by the bytes in a block
        assert set(range(a, b)) <= want[i]
