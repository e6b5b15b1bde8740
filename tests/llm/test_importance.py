import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from reelhouse.llm import importance
from reelhouse.llm.common import table
from reelhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    w = WORD.findall((text or "").encode().lower())
    return len(w), [b" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(docs, target):
    """(doc_id, n_features, weight, score, rank) of each (doc_id, text), as the contract says it."""
    s = Counter(zlib.crc32(f) % 10000 for _, t in docs for f in grams(t)[1])
    t = Counter(zlib.crc32(f) % 10000 for x in target for f in grams(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    out = []
    for k, (i, text) in enumerate(docs):
        n, fs = grams(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (ns + 10000) / ((s[b] + 1) * (nt + 10000)))) for f in fs for b in [zlib.crc32(f) % 10000])
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), k))
    order = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -(1 << 63) if r[0] is None else r[0]))
    rank = {r[5]: k + 1 for k, r in enumerate(order[:5 * len(order) // 100])}
    return [(i, f, w, s, rank.get(k)) for i, _, f, w, s, k in out]


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query_against_plain_version(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    target = [r[0] for r in table(spark, SF, "benchmark").select("text").collect()]
    got = QUERIES["op11_importance_resampling"](spark, SF)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert rows_of(got) == sorted(plain(docs, target), key=repr)


@pytest.fixture()
def odd(spark):
    rng = random.Random(3)
    words = ["the", "Of", "été", "中文字", "x" * 60, "q" * 49, "r9", "a-b", "\x00", " z"]
    texts = [None, "", "...", "one", "one two"] + [" ".join(rng.choice(words) for _ in range(rng.randint(15, 60))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, "a b " * 30), (None, None)]
    rows += [(500, "same text of many words " * 8)] * 40  # rows that repeat id and text
    return rows


def test_odd_rows_pieces_and_clashing_columns(spark, odd, monkeypatch):
    frame = spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in odd], "doc_id long, text string, neg int, row int, Rank int, mark string").repartition(7)
    target = ["the été 中文字 of", None, ""]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    expect = plain(odd, target)
    for piece in (importance.PIECE, 64):
        monkeypatch.setattr(importance, "PIECE", piece)
        got = rows_of(importance.resampled(frame, bench))
        assert [r[:4] for r in got] == [r[:4] for r in sorted(expect, key=repr)]
        # Repeated rows may swap ranks among themselves only.
        assert Counter((r[0], r[3], r[4]) for r in got) == Counter((r[0], r[3], r[4]) for r in expect)
    empty = frame.limit(0)
    assert importance.resampled(empty, bench).count() == 0
    no_target = plain(odd, [])
    assert Counter(r[:4] for r in rows_of(importance.resampled(frame, bench.limit(0)))) == Counter(r[:4] for r in no_target)


@pytest.mark.parametrize("shape", ["random", "ties", "sorted"])
def test_cutoff_is_exact(spark, shape):
    rng = np.random.default_rng(5)
    n = 3000
    neg = {"random": rng.integers(-10**6, 10**6, n), "ties": rng.integers(0, 3, n), "sorted": np.arange(n)}[shape].tolist()
    ids = [x if x % 5 else importance.LEAST_ID for x in rng.integers(0, 50, n).tolist()]
    keys = [(a, b, int(c), k) for k, (a, b, c) in enumerate(zip(neg, ids, rng.integers(0, 3, n)))]
    frame = spark.createDataFrame(keys, "neg long, id long, mark long, row long").repartition(6).cache()
    want = sorted(keys)
    for k in (1, 2, 700, n - 1, n):
        assert importance.cutoff(frame, k) == want[k - 1]
    assert importance.cutoff(frame, 0) is None and importance.cutoff(frame, n + 1) is None


def test_each_round_discards_a_quarter():
    rng = random.Random(9)
    for _ in range(200):
        parts = [sorted(rng.sample(range(10**6), rng.randint(1, 60))) for _ in range(rng.randint(1, 12))]
        pivot = importance.weighted_median([(len(p), (p[(len(p) - 1) // 2],)) for p in parts])[0]
        every = [x for p in parts for x in p]
        assert sum(x <= pivot for x in every) * 4 >= len(every) and sum(x >= pivot for x in every) * 4 >= len(every)
