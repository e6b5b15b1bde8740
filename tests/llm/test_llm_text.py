"""Operators on documents against plain versions, on small fixtures with the
awkward rows: nulls, empty texts, long texts, ties, repeats, clashing names."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import (
    chat_format, decontaminate, exact_dedup, language_id, lm_score,
    minhash_dedup, mixing, sharding, suffix_dedup, token_counts,
)
from reelhouse.llm.arrays import pack, unpack
from reelhouse.llm.elias_fano import EliasFano

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, taken string, mark int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abeltorsé") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    out, texts = [], []
    for i in range(160):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 80))]
        if i % 4 == 0:
            words += passage.split()
        if i % 5 == 1 and texts:  # a near copy
            words = texts[-1].split()
            words[rng.randrange(len(words))] = "changed"
        text = " ".join(words)
        texts.append(text)
        out.append((i, text.upper() if i % 13 == 0 else text, rng.choice(["en", "fr", None]), f"src{i % 4}" if i % 9 else None))
    out += [(200 + i, texts[3], "en", "src0") for i in range(60)]  # one text holds a quarter of the rows
    out += [(300, None, None, None), (301, "", "en", "src1"), (302, " \t\n", "en", "src1"), (303, "!!! 123", "fr", "src2"),
            (304, "word " * 30_000, "en", "src2"), (305, "x" * 5_000, None, "src3"), (None, texts[3], "en", "src0"),
            (306, texts[7], "en", "src1"), (306, texts[7], "en", "src1"), (307, "one", "en", "src2")]
    return [(i, t, a, s, 0, 1, "x", 2) for i, t, a, s in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text):
    return (text or "").encode().lower()


def test_exact_dedup(docs, rows, empty):
    groups = {}
    for r in rows:
        groups.setdefault(hashlib.sha256(low(r[1])).hexdigest(), []).append(r[0])
    got = exact_dedup.exact_dedup(docs, buckets=4).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r.text_sha256]
        best = max(i for i in ids if i is not None)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(ids), r.doc_id == best)
    assert exact_dedup.exact_dedup(empty, buckets=4).count() == 0


def test_digest_index_is_idempotent(spark, docs):
    index = exact_dedup.DigestIndex(spark, "digest_index_test", 4)
    load = exact_dedup.with_digest(docs)
    index.add(load)
    n = index.frame().count()
    index.add(load)
    assert index.frame().count() == n == load.select("digest").distinct().count()


def test_shards_are_even_gapless_and_keep_columns(spark, docs, rows, empty):
    got = sharding.histogram_shard(docs, shards=4).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {*docs.columns, "slot"}
    size = lambda r: len((r.text or "").encode()) + 1
    total, largest = sum(map(size, got)), max(map(size, got))
    for s in range(4):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(map(size, mine)) - total / 4) <= largest
    assert sharding.histogram_shard(empty).count() == 0
    # A text that fills most of the table is cut by id, and the shards stay even.
    hot = spark.createDataFrame([(i, "same text") for i in range(4000)] + [(None, None)], "doc_id long, text string")
    n = Counter(r.shard for r in sharding.histogram_shard(hot).select("shard").collect())
    assert len(n) == 16 and max(n.values()) - min(n.values()) <= 40


def brute_classes(rows, width):
    texts = [(r[0], low(r[1]).split()) for r in rows]
    sets = [frozenset(tuple(w[j:j + min(width, len(w))]) for j in range(len(w) - min(width, len(w)) + 1)) if w else frozenset() for _, w in texts]
    comp = list(range(len(sets)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                comp[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(texts):
        ids.setdefault(root(i), []).append(d)
    return Counter((d, len(sets[i]), min((x for x in ids[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(texts))


@pytest.mark.parametrize("width", [2, 5])
def test_near_classes(docs, rows, empty, width):
    got = minhash_dedup.near_classes(docs, width=width).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_classes(rows, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    if width == 5:
        assert minhash_dedup.near_classes(empty).count() == 0
        kept = minhash_dedup.near_dedup(docs)
        assert kept.columns == docs.columns
        stay = [r.doc_id for r in kept.collect()]
        assert len(stay) == len(set(stay)) and set(stay) == {r.doc_id for r in got if r.kept}


def test_similarity_estimate_is_corrected(spark):
    rng = np.random.default_rng(1)
    both = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    sets = [np.unique(np.concatenate([both, rng.integers(0, 1 << 63, 200, dtype=np.uint64)])) for _ in range(2)]
    sig = [minhash_dedup.packed(minhash_dedup.minima(s)).tolist() for s in sets]
    lanes = lambda x: [F.lit(v) for v in x]
    got = spark.range(1).select(minhash_dedup.similarity(lanes(sig[0]), lanes(sig[1]))).first()[0]
    assert abs(got - 800 / 1200) < 0.15


def test_token_counts(docs, rows, empty):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    want = Counter((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in rows)
    got = token_counts.token_counts(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts.token_counts(empty).count() == 0
    rng = random.Random(6)
    odd = ["".join(rng.choice(" ▁abethrouz\n\t.,<>é日😀_0x19") for _ in range(rng.randint(0, 90))) for _ in range(400)]
    # Pre-tokens of any length go one path: no spaces, one character, equal ranks (runs of spaces), dense ranks.
    odd += ["x" * 100_000, "漢字" * 20_000, "abc" * 20_000, " " * 20_000, " " * 3_001 + "word", "-=" * 9_000, "=-----" * 5_000]
    odd += ["".join(rng.choice(of) for _ in range(20_000)) for of in ("日本語中国人大学生先", "ACGT", "abcdefghijklmnopqrstuvwxyz", " =-", "é à")]
    assert token_counts._merger(token_counts.MODEL).counts(odd) == [len(model.encode(t)) for t in odd]


def test_tokens_of_portions(monkeypatch):
    merger = token_counts._merger(token_counts.MODEL)
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdehilorstu漢字-") for _ in range(rng.randint(1, 400))) for _ in range(200)]
    whole = merger.count(words).tolist()
    monkeypatch.setattr(token_counts, "PORTION", 50)
    assert merger.count(words).tolist() == whole


def test_language_id(spark, docs, empty):
    syllables = {"aa": "stre gro blin mer", "ab": "stre gro blan mur", "ba": "iño ela ora que", "bb": "ião ela ora ção"}
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choice(syllables[a].split()) for _ in range(2)) for _ in range(30)), a)
            for i in range(600) for a in [rng.choice(sorted(syllables))]]
    rows += [(900, None, "aa"), (901, "12 !!", "aa"), (902, "", None), (None, "stregro", "aa")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(table)
    assert sorted(map(sorted, model.families)) == [["aa", "ab"], ["ba", "bb"]]
    got = {r.doc_id: r for r in language_id.identify(table, model).collect()}
    held = [r for r in rows if r[0] is not None and r[0] < 900 and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert np.mean([got[i].lang_pred == a for i, _, a in held]) > 0.95
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.identified(empty).count() == 0 and language_id.learn(empty).families == []
    assert {r.doc_id for r in language_id.identified(docs).collect()}.isdisjoint({300, 301, 302, 303})


def test_long_text_is_described_in_pieces(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcé日 .1\n") for _ in range(n)) for n in (1, 2, 3, 50, 400)] + ["..a", "1 2", "a..", " " * 9 + "b"]
    whole = [language_id.describe(t) for t in texts]
    for piece in (1, 2, 3, 7):
        monkeypatch.setattr(language_id, "PIECE", piece)
        for t, v in zip(texts, whole):
            got = language_id.describe(t)
            assert (got is None) == (v is None) and (v is None or (got == v).all())


def test_mix(docs, rows, empty):
    got = mixing.mix(docs, block=16, shard_slots=32).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(low(r[1]).split())
    assert len(got) == len(rows)
    want = dict(zip(order := sorted(sizes, key=lambda s: (s is None, s or "")), mixing.targets([sizes[s] for s in order])))
    assert math.isclose(sum(want.values()), 1.5 * sum(sizes.values()))
    taken = Counter()
    source = {(r[0], len(low(r[1]).split())): r[3] for r in rows}
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 16 for s in sizes)
    again = mixing.mix(docs.repartition(3), block=16, shard_slots=32).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mix(empty).count() == 0 and mixing.mixed(docs).columns == docs.columns


def test_mixed_rows_meet_the_targets(spark):
    # Long and short documents, a target that is no whole multiple of its source.
    rng = random.Random(9)
    rows = [(i, "w " * (rng.choice([5, 40, 400])), "abc"[min(i % 5, 2)]) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes, got = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += len(t) // 2
    out = mixing.mixed(table, block=16, shard_slots=64).collect()
    for r in out:
        got[r.source] += len(r.text) // 2
    want = dict(zip("abc", mixing.targets([sizes[s] for s in "abc"])))
    assert any(want[s] % sizes[s] for s in want) and max(Counter(r.doc_id for r in out).values()) <= 2
    assert all(abs(got[s] - want[s]) <= 0.05 * want[s] for s in want)


def test_permutations_are_exact(spark):

    for n in (1, 2, 7, 100):
        x = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3).cast("long")).alias("p"))
        y = x.select("id", "p", mixing.permuted(F.col("p"), F.lit(n).cast("long"), F.lit(3).cast("long"), back=True).alias("b")).collect()
        assert sorted(r.p for r in y) == list(range(n)) and all(r.b == r.id for r in y)


def test_targets_reshare_the_excess():
    assert mixing.targets([10, 1000, 1000]) == [20.0, pytest.approx((3015 - 20) / 3), pytest.approx((3015 - 20) * 2 / 3)]
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]


def test_decontamination(spark, docs, empty):
    items = ["Tom has 12 apples and gives 5 apples to his friend Anna, so 12 minus 5 are left for him today.",
             "The train leaves the old station and travels 60 km in two hours before it reaches the coast.",
             None, "", "of it", "short item of words",
             "a river runs under seven bridges past the mill and the old church until it meets the wide and quiet sea near home"]
    bench = spark.createDataFrame(list(enumerate(items)) + [(None, "nothing that any document here would ever hold at all")], "item_id long, text string")
    texts = {
        1: "so it goes. " + items[0] + " the end",  # as it is
        2: items[0].upper(), 3: items[0].replace("12", "30").replace("5", "8").replace("Anna", "Maria"),  # other case, other values
        4: items[0].replace("12", "30", 1),  # 12 becomes 30 and 12, but 18 words in a row are the item's
        5: "The train stands still. Tom has a friend.", 6: None, 7: "", 8: "well, " + items[1].replace("60 km", "75 miles"),
        9: "we say short item of words here", 10: "first " + " ".join(items[6].split()[5:19]) + " nothing else follows", 11: " ".join(items[6].split()[5:15]),
    }
    table = spark.createDataFrame(list(texts.items()) + [(1, texts[1])], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(table, bench).collect()}
    assert {i for i, r in got.items() if r.contaminated} == {1, 2, 3, 4, 8, 9, 10}
    assert got[3].item_ids == [0] and got[8].item_ids == [1] and got[9].item_ids == [5]
    clean = decontaminate.decontaminated(table, bench)
    assert clean.columns == table.columns and {r.doc_id for r in clean.collect()} == {5, 6, 7, 11}
    none = bench.where("false")
    assert decontaminate.contamination(docs, none).where("contaminated").count() == 0
    assert decontaminate.contamination(empty, bench).count() == 0


def brute_passages(rows):
    seen, out = set(), []
    for i, t in sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = True
            seen.add(b[s:s + 100])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), kept))
    return out


def test_passages(docs, rows, empty):
    got = suffix_dedup.passage_dedup(docs).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == set(brute_passages(rows))
    assert suffix_dedup.passage_dedup(empty).count() == 0


def test_passages_of_hot_anchors(spark, docs, rows, monkeypatch):
    """Anchors with many regions, whose strings are spread: the same results."""
    monkeypatch.setattr(suffix_dedup, "HOT_REGIONS", 1)
    got = suffix_dedup.passage_dedup(docs).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == set(brute_passages(rows))
    # A passage with other words around it in every text, twice in some, a short one, and rows that repeat.
    rng = random.Random(4)
    some = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, short = some(230), some(60)
    made = [(i, some(rng.randint(0, 90)) + passage[:230 - i % 7] + some(rng.randint(0, 90)) + (passage if i % 5 == 0 else short)) for i in range(60)]
    made += made[:3] + [(69, made[20][1]), (70, passage)]
    for hot in (1, 20, 10 ** 6):
        monkeypatch.setattr(suffix_dedup, "HOT_REGIONS", hot)
        got = suffix_dedup.passage_dedup(spark.createDataFrame(made, "doc_id long, text string").repartition(5)).collect()
        assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == set(brute_passages(made))


def test_suffix_order():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, (300, suffix_dedup.SPAN)).astype(np.uint8)
    data[100:, suffix_dedup.LEFT:suffix_dedup.LEFT + 40] = data[0, suffix_dedup.LEFT:suffix_dedup.LEFT + 40]
    hi = rng.integers(suffix_dedup.LEFT + 40, suffix_dedup.SPAN + 1, 300)
    data[np.arange(suffix_dedup.SPAN) >= hi[:, None]] = 0
    group = np.sort(rng.integers(0, 5, 300))
    order = suffix_dedup.Regions(data, np.zeros(300, np.int64), hi).sorted(group)
    text = [bytes(data[i, suffix_dedup.LEFT:hi[i]]) for i in range(300)]
    assert order.tolist() == sorted(range(300), key=lambda i: (group[i], text[i], i))


def test_long_text_is_scanned_in_pieces(monkeypatch):
    text = np.random.default_rng(1).integers(97, 100, 9000).astype(np.uint8).tobytes()
    whole = suffix_dedup.text_anchors(text)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    pieces = suffix_dedup.text_anchors(text)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all()


def scores_agree(rows, got):
    """The trigram model, plainly."""
    train = [r for r in rows if not (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2)]
    tokens = lambda t: low(t).split() + [None]
    uni, big, tri, ctx, after = Counter(), Counter(), Counter(), Counter(), Counter()
    for r in train:
        w = tokens(r[1])
        uni.update(w)
        big.update(zip([0] + w[:-1], w))
        tri.update(zip([0] + w[:-2], w[:-1], w[1:]))
    for (a, _), n in big.items():
        ctx[a] += n
    for (a, b, _), n in tri.items():
        after[a, b] += n
    n, v, m = sum(uni.values()), len(uni), lm_score.M
    p1 = lambda x: (uni[x] + 1) / (n + v + 1)
    p2 = lambda a, x: (big[a, x] + m * p1(x)) / (ctx[a] + m)
    p3 = lambda a, b, x: (tri[a, b, x] + m * p2(b, x)) / (after[a, b] + m)
    got = sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.base_score))
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(rows)
    for r, row in zip(got, rows):
        w = tokens(row[1])
        base = sum(math.log10(p1(x)) for x in w)
        score = math.log10(p2(0, w[0])) + sum(math.log10(p3(*x)) for x in zip([0] + w[:-2], w[:-1], w[1:]))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(uni[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and abs(r.score - score) <= 0.02 * len(w)


def test_lm_scores(docs, rows, empty):
    scores_agree(rows, lm_score.lm_scores(docs, ~lm_score.held_out()).collect())
    assert lm_score.lm_scores(empty, ~lm_score.held_out()).count() == 0


def test_lm_scores_of_hot_contexts(spark, monkeypatch):
    """Frequent words, a frequent bigram and frequent first words; many blocks and shards."""
    monkeypatch.setattr(lm_score, "HOT", 12)
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 100)
    rng = random.Random(3)
    some = [f"w{k}" for k in range(30)]
    rows = [(i, " ".join(["once"] * (i % 3 > 0) + [x for _ in range(rng.randint(0, 9)) for x in ("of", "the", rng.choice(some))])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    blocks = lm_score.blocks_of(docs.select("doc_id", ~lm_score.held_out(), F.col("text").cast("binary")))
    trained = blocks.agg(F.sum("trained")).first()[0]
    hot, _ = lm_score.hot_words(blocks, trained)
    assert len(lm_score.hot_pairs(blocks, hot, trained)[0]) >= 1
    scores_agree(rows, lm_score.lm_scores(docs, ~lm_score.held_out()).collect())


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for universe in (1 << 64, 1 << 20, 5):
        for n in (0, 1, 2, 500):
            v = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
            e = EliasFano.of(v, universe)
            assert (e.access(np.arange(n)) == v).all()
            q = np.concatenate([v, rng.integers(0, universe, 50, dtype=np.uint64)])
            at = e.find(q)
            assert ((at >= 0) == np.isin(q, v)).all() and (v[at[at >= 0]] == q[at >= 0]).all()
    a, b = np.arange(7, dtype=np.uint32), np.empty(0, np.uint64)
    assert [x.tolist() for x in unpack(pack(a, b))] == [a.tolist(), []]


def test_preference_format(spark):
    t = lambda *xs: [(i, r, x) for i, (r, x) in enumerate(xs)]
    user, a, b = ("user", "hi <|im_end|>"), ("assistant", "good é"), ("assistant", "bad")
    pairs = spark.createDataFrame([
        (1, t(user, a), t(user, b)), (2, t(user, a, ("user", None)), t(user, a, ("user", ""))), (3, t(user), t(user)), (4, None, t(user)), (5, [], []),
    ], "pair_id long, chosen array<struct<turn:bigint,role:string,text:string>>, rejected array<struct<turn:bigint,role:string,text:string>>")
    got = {r.pair_id: r for r in chat_format.preference_format(pairs).collect()}
    one = got[1]
    assert one.prompt == "<|im_start|>user\nhi < |im_end|><|im_end|>\n<|im_start|>assistant\n"
    assert (one.chosen, one.rejected) == ("good é<|im_end|>\n", "bad<|im_end|>\n")
    assert [one.chosen[s.start:s.end] for s in one.chosen_mask] == ["good é<|im_end|>"]
    assert got[2].prompt_turns == 2 and got[2].chosen == got[2].rejected == "<|im_start|>user\n<|im_end|>\n" and got[2].chosen_mask == []
    assert got[3].same and got[3].chosen == "" and got[4].prompt == "" and got[4].chosen == "" and got[5].same


def test_parroted_pairs(spark):
    turns = spark.createDataFrame([(7, 1, "assistant", "b"), (7, 0, "user", "a"), (7, 0, "user", "a"), (8, 0, "user", "only"), (None, 0, None, None),
                                   (9, 0, "user", "p"), (9, 1, "assistant", "q"), (9, 2, "user", "r"), (9, 3, "assistant", "s")],
                                  "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in chat_format.parroted(turns).collect()}
    assert [x.text for x in got[7].chosen] == ["a", "b"] and [x.text for x in got[7].rejected] == ["a", "a"]
    assert got[8].rejected == [] and len(got[None].chosen) == 1
    assert [x.text for x in got[9].rejected] == ["p", "q", "r", "r"]  # 9 mod 2 replies: from the second on
