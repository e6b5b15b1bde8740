"""Language-model scores from Elias-Fano n-gram tries.

The model is a trigram model with interpolated smoothing: P(w|h) = a(hw) +
b(h) P'(w), where h are the one or two words before w in its text (the begin of
the text counts as one), a(hw) = c(hw) / (c(h) + M), b(h) = M / (c(h) + M), and P'
is the next shorter model, at last the add-one estimate that is also the baseline.
It is a trie with three levels, split into shards by the hash of the first word.
In a shard, the contexts are one Elias-Fano sequence; monotone pointers, another
one, give each context its range of successors; the successors, as values
relative to their context, are a third; pointers from each of these give the
third level in the same way. The a(hw) of both levels and the b(h) of bigrams are
quantised to eight bits. A shard is written to a file of the task, mapped into
memory and queried by searching a context's range for the successor.

Nothing is broadcast that grows: texts are turned into blocks of token numbers;
a block sends its distinct words, bigrams and trigrams to their shards, counts
included, and gets back what the shards' tries say about them; then its texts are
scored. So a trigram crosses the network once per block, however often it occurs.
Contexts that make up more than 1 / ``HOT`` of all tokens (fewer than HOT words,
and fewer than HOT bigrams, so their lists are bounded) are counted beforehand,
and what follows them is spread over all shards by successor.

Defined results: a null or empty text is one token, its end; score and base of
unseen words come from the add-one estimate; if nothing is learnt from (an empty
table, all held out) N and V are 0 and every log probability is that of 1 / 1,
0; a null id is crc32 of nothing, its rows are learnt from; repeated rows are
texts of their own; an empty table gives an empty result. Only id and text are
read. Words are told apart by 64-bit hashes, successors of one context by 40 bits.
"""

from __future__ import annotations

import mmap
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.arrays import pack, unpack
from reelhouse.llm.common import portions, stage, table, words_of
from reelhouse.llm.elias_fano import EliasFano

#: Weight of the lower order in smoothing.
M = 4.0
#: Text bytes to a block, tokens of the corpus to a shard.
BLOCK_BYTES, SHARD_TOKENS = 8 << 20, 1_000_000
HOT, LEAST_SHARDS = 1000, 16
#: Quantised log10 probabilities: code 1 is 10**LOWEST, code 255 is 1; 0 means absent.
LOWEST = -10.0
SUCC_BITS = np.uint64(40)
_SUCC_MASK = (np.uint64(1) << SUCC_BITS) - np.uint64(1)
_END, _BEGIN = xxhash.xxh3_64_intdigest(b" end"), xxhash.xxh3_64_intdigest(b" begin")  # no word has a space


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def five_bytes(a: np.ndarray) -> np.ndarray:
    return a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].reshape(-1).copy()


def from_five(a: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a) // 5, 8), dtype=np.uint8)
    out[:, :5] = a.reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def quantise(p: np.ndarray) -> np.ndarray:
    code = np.rint((np.log10(p) - LOWEST) * (254 / -LOWEST)) + 1
    return np.clip(code, 1, 255).astype(np.uint8)


#: Probability of each code.
PROBABILITY = np.concatenate([[0.0], 10 ** (LOWEST + np.arange(255) * (-LOWEST / 254))])


# --- 1: texts to blocks -----------------------------------------------------------
def blocks_of(docs: DataFrame) -> DataFrame:
    """Blocks of (doc_id, train, text): token numbers, word hashes, frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2, BLOCK_BYTES):
                number: dict[bytes, int] = {b" end": 0}
                sizes, tokens = [], []
                for t in part.column(2).to_pylist():
                    words = words_of(t)
                    sizes.append(len(words) + 1)
                    tokens.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint32, len(words)))
                    tokens.append(np.zeros(1, np.uint32))
                flat = np.concatenate(tokens)
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
                train = np.repeat(part.column(1).to_numpy(zero_copy_only=False), sizes)
                counts = np.bincount(flat[train], minlength=len(number))
                often = np.flatnonzero(counts * 2 * HOT > train.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.array([uuid.uuid4().int >> 65]), pa.array([part.column(0)], pa.list_(pa.int64())),
                    pa.array([part.column(1)], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([pack(flat, hashes)], pa.binary()), pa.array([hashes[often].view(np.int64)], pa.list_(pa.int64())),
                    pa.array([counts[often]], pa.list_(pa.int64())), pa.array([int(train.sum())])],
                    ["block", "ids", "train", "sizes", "data", "often", "times", "trained"])

    return docs.mapInArrow(run, "block long, ids array<long>, train array<boolean>, sizes array<int>, data binary, often array<long>, times array<long>, trained long")


def hot_words(blocks: DataFrame, trained: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and exact counts of the words with over 1 / HOT of all tokens.

    Blocks tell the words that have over half that share of their own tokens. In
    the other blocks a word has less than that, so half of a frequent word's tokens
    are told: the candidates are the words with so many, fewer than 2 * HOT.
    """
    told = blocks.select(F.explode(F.arrays_zip("often", "times")).alias("w")).select("w.*")
    often = told.groupBy("often").agg(F.sum("times").alias("times")).where(F.col("times") * 2 * HOT > trained).select("often")
    maybe = np.sort(often.toArrow()["often"].to_numpy().view(np.uint64)) if trained else np.empty(0, np.uint64)
    if not len(maybe):
        return maybe, np.empty(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(maybe), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):  # one block at a time in memory
                data, train, sizes = (batch.column(c)[i].as_py() for c in range(3))
                flat, hashes = unpack(data)
                counts = np.bincount(flat[np.repeat(train, sizes)], minlength=len(hashes))
                at = np.minimum(np.searchsorted(maybe, hashes), len(maybe) - 1)
                here = maybe[at] == hashes
                np.add.at(total, at[here], counts[here])
        yield pa.RecordBatch.from_arrays([pa.array(maybe.view(np.int64)), pa.array(total)], ["word", "n"])

    counted = blocks.select("data", "train", "sizes").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    got = counted.where(F.col("n") * HOT > trained).toArrow()
    words = got["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], got["n"].to_numpy()[order]


def places(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Position of each value in a sorted array, -1 where it is not in it."""
    if not len(sorted_):
        return np.full(len(values), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return np.where(sorted_[at] == values, at, -1)


def hot_pairs(blocks: DataFrame, hot: np.ndarray, trained: int) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams with over 1 / HOT of all tokens, as sorted numbers (place of the first word in
    ``hot`` times its length plus that of the second), with their exact counts. Both words of
    such a bigram are in ``hot``, so a task counts fewer than HOT * HOT of them."""
    if not len(hot):
        return np.empty(0, np.int64), np.empty(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(hot) ** 2, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                data, train, sizes = (batch.column(c)[i].as_py() for c in range(3))
                flat, hashes = unpack(data)
                place = places(hot, np.append(hashes, np.uint64(_BEGIN)))
                u, v = place[before_of(flat, np.array(sizes, dtype=np.int64), len(hashes))], place[flat]
                v[flat == 0] = -1  # nothing follows an end
                both = (u >= 0) & (v >= 0) & np.repeat(train, sizes)
                total += np.bincount(u[both] * len(hot) + v[both], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["pair", "n"])

    counted = blocks.select("data", "train", "sizes").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    got = counted.where(F.col("n") * HOT > trained).toArrow()
    order = np.argsort(got["pair"].to_numpy())
    return got["pair"].to_numpy()[order], got["n"].to_numpy()[order]


def before_of(tokens: np.ndarray, sizes: np.ndarray, begin: int) -> np.ndarray:
    """The token before each, ``begin`` at the first of a text."""
    before = np.empty(len(tokens), dtype=np.int64)
    before[1:] = tokens[:-1]
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = begin
    return before


# --- 2: blocks to shards ----------------------------------------------------------
class Block:
    """Distinct words, bigrams and trigrams of a block in the order in which shards see them."""

    def __init__(self, data: bytes, train: list[bool], sizes: list[int], shards: int, hot: np.ndarray, hot2: np.ndarray):
        self.tokens, hashes = unpack(data)
        self.sizes = np.array(sizes, dtype=np.int64)
        learnt = np.repeat(np.array(train, dtype=bool), self.sizes)
        self.hashes = np.append(hashes, np.uint64(_BEGIN))
        begin = len(hashes)
        before = before_of(self.tokens, self.sizes, begin)
        self.word_counts = np.bincount(self.tokens[learnt], minlength=begin + 1)
        self.word_counts[begin] = int(np.count_nonzero(train))
        self.pairs, pair_of = np.unique(before << 32 | self.tokens, return_inverse=True)
        self.inner = np.flatnonzero(before != begin).astype(np.int32)
        del before
        self.pair_of = pair_of.astype(np.int32)
        self.pair_counts = np.bincount(self.pair_of[learnt], minlength=len(self.pairs))
        # A trigram is a bigram (by its place in ``pairs``) and the token after it.
        self.triples, triple_of = np.unique(pair_of[self.inner - 1] << 32 | self.tokens[self.inner], return_inverse=True)
        self.triple_of = triple_of.astype(np.int32)
        del pair_of, triple_of
        self.triple_counts = np.bincount(self.triple_of[learnt[self.inner]], minlength=len(self.triples))
        mixed = (self.hashes ^ (self.hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        home = (mixed % np.uint64(shards)).astype(np.int64)
        context, last = (self.pairs >> 32).astype(np.int32), (self.pairs & 0xFFFFFFFF).astype(np.int32)
        tails = self.hashes & _SUCC_MASK
        spread = (tails % np.uint64(shards)).astype(np.int64)
        place = places(hot, self.hashes)
        self.tails, self.last, self.place = tails, last, place
        pair_shard = np.where(place[context] >= 0, (home[context] + spread[last]) % shards, home[context])
        pair_place = np.where((place[context] >= 0) & (place[last] >= 0), place[context] * len(hot) + place[last], -1)
        #: Number of each bigram among the hot ones, -1 for all others.
        self.hot_pair = places(hot2, pair_place)
        after, third = (self.triples >> 32).astype(np.int32), (self.triples & 0xFFFFFFFF).astype(np.int32)
        self.third = third
        split = self.hot_pair[after] >= 0
        triple_shard = np.where(split, (pair_shard[after] + spread[third]) % shards, pair_shard[after])
        self.word_order, self.word_cut = self._dealt(home, shards)
        self.pair_order, self.pair_cut = self._dealt(pair_shard, shards)
        # In a shard, the trigrams of hot bigrams stand after the others.
        halves = np.concatenate([np.flatnonzero(~split), np.flatnonzero(split)])
        order, self.triple_cut = self._dealt(triple_shard[halves], shards)
        self.triple_order = halves[order]

    @staticmethod
    def _dealt(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        # Sixteen bits are sorted by counting.
        order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
        return order, np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])

    def words(self, s: int) -> np.ndarray:
        return self.word_order[self.word_cut[s]:self.word_cut[s + 1]]

    def bigrams(self, s: int) -> np.ndarray:
        return self.pair_order[self.pair_cut[s]:self.pair_cut[s + 1]]

    def trigrams(self, s: int) -> np.ndarray:
        return self.triple_order[self.triple_cut[s]:self.triple_cut[s + 1]]

    def shards(self) -> list[int]:
        """Those that the block has something for."""
        return np.flatnonzero((np.diff(self.word_cut) > 0) | (np.diff(self.pair_cut) > 0) | (np.diff(self.triple_cut) > 0)).tolist()

    def part(self, s: int) -> bytes:
        """Words and counts; contexts (places of words, or beyond them of hot words), their number of bigrams; successors, counts; number of
        trigrams of each bigram; hot bigrams, their number of trigrams; successors, counts;
        the words that successors are the places of (a word follows many others)."""
        w, p, t = self.words(s), self.bigrams(s), self.trigrams(s)
        context, after = self.pairs[p] >> 32, self.triples[t] >> 32
        hot = self.hot_pair[after]
        k = int(np.count_nonzero(hot < 0))
        new, hot_new = _starts(context), _starts(hot[k:])
        thirds = np.bincount(np.searchsorted(p, after[:k]), minlength=len(p))
        of = context[new]
        # A context that is not hot is a word of this shard.
        at = np.searchsorted(w, of)
        at = np.where(np.isin(of, w), at, len(w) + self.place[of]).astype(np.uint32)
        last, third = self.last[p], self.third[t]
        follows = np.zeros(len(self.hashes), dtype=bool)
        follows[last] = follows[third] = True
        place = (np.cumsum(follows) - 1).astype(np.uint32)
        return pack(self.hashes[w], self.word_counts[w].astype(np.uint32), at,
                    np.diff(np.r_[new, len(p)]).astype(np.uint32), place[last], self.pair_counts[p].astype(np.uint32),
                    thirds.astype(np.uint32), hot[k:][hot_new].astype(np.uint32), np.diff(np.r_[hot_new, len(t) - k]).astype(np.uint32),
                    place[third], self.triple_counts[t].astype(np.uint32), five_bytes(self.tails[follows]))


def _starts(of: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)


class Trie:
    """One shard of the model, in a mapped file of this task."""

    def __init__(self, words: np.ndarray, word_n: np.ndarray, contexts: np.ndarray, context_n: np.ndarray,
                 pair_context: np.ndarray, succ: np.ndarray, pair_n: np.ndarray,
                 split_n: np.ndarray, triple_context: np.ndarray, third: np.ndarray, triple_n: np.ndarray):
        """Sorted words with counts; sorted contexts with counts; bigrams sorted by (context position, successor),
        with counts; counts of hot bigrams, whose positions come after those of the bigrams; trigrams sorted by
        (bigram position, successor)."""
        after_n = np.concatenate([pair_n, split_n])
        levels = [EliasFano.of(contexts, 1 << 64), *self._level(len(contexts), pair_context, succ),
                  EliasFano.of(words, 1 << 64), *self._level(len(after_n), triple_context, third)]
        codes = quantise(pair_n / (context_n[pair_context] + M))
        rest = quantise(M / (pair_n + M))
        codes3 = quantise(triple_n / (after_n[triple_context] + M))
        shapes = [(e.n, e.shift) for e in levels]
        parts = self._mapped([getattr(e, f) for e in levels for f in EliasFano.FIELDS] + [codes, rest, codes3, word_n])
        self.level1, self.pointers2, self.level2, self.vocabulary, self.pointers3, self.level3 = (
            EliasFano(n, shift, *parts[3 * k:3 * k + 3]) for k, (n, shift) in enumerate(shapes))
        self.codes, self.rest, self.codes3, self.word_n = parts[18:]

    @staticmethod
    def _level(contexts: int, context: np.ndarray, succ: np.ndarray) -> tuple[EliasFano, EliasFano]:
        """Pointers to the ranges of successors, and the successors relative to their contexts."""
        starts = np.searchsorted(context, np.arange(contexts + 1))
        return (EliasFano.of(starts, len(succ) + 1),
                EliasFano.of(context.astype(np.uint64) << SUCC_BITS | succ, max(1, contexts) << int(SUCC_BITS)))

    @staticmethod
    def _mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
        """The arrays, read from a file that vanishes with this task."""
        with tempfile.TemporaryFile() as f:
            at = []
            for a in arrays:
                f.write(b"\0" * (-f.tell() % 8))
                at.append(f.tell())
                f.write(np.ascontiguousarray(a).data if len(a) else b"")
            f.write(b"\0" * 8)
            f.flush()
            mapped = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        return [np.frombuffer(mapped, a.dtype, len(a), k) for a, k in zip(arrays, at)]

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of words, 0 for unknown ones."""
        at = self.vocabulary.find(hashes)
        return np.where(at >= 0, self.word_n[at] if len(self.word_n) else 0, 0)

    def bigrams(self, contexts: np.ndarray, sizes: np.ndarray, succ: np.ndarray) -> np.ndarray:
        """Positions of the bigrams of each context (``sizes`` successors each), -1 for unknown ones."""
        return self._within(self.pointers2, self.level2, self.level1.find(contexts), sizes, succ)

    def trigrams(self, pairs: np.ndarray, sizes: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Positions of the trigrams of each bigram, given by its position or -1, -1 for unknown ones."""
        return self._within(self.pointers3, self.level3, pairs, sizes, third)

    @staticmethod
    def _within(pointers: EliasFano, level: EliasFano, at: np.ndarray, sizes: np.ndarray, succ: np.ndarray) -> np.ndarray:
        out = np.full(len(succ), -1, np.int64)
        rows = np.flatnonzero(np.repeat(at >= 0, sizes))
        if len(rows) and level.n:
            known, times = at[at >= 0], sizes[at >= 0]
            start, stop = (np.repeat(pointers.access(known + k).astype(np.int64), times) for k in (0, 1))
            want = np.repeat(known.astype(np.uint64), times) << SUCC_BITS | succ[rows]
            found = level.successor(want, start, stop)
            hit = (found < stop) & (level.access(np.minimum(found, level.n - 1)) == want)
            out[rows[hit]] = found[hit]
        return out


def _stretches(sizes: np.ndarray, most: int = 500_000) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of contexts, and of their bigrams, of about ``most`` bigrams each."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        x = int(ends[a] - sizes[a])
        b = max(a + 1, int(np.searchsorted(ends, x + most, side="right")))
        yield a, b, x, int(ends[b - 1])
        a = b


def answered(shard: pa.Table, hot: np.ndarray, hot_n: np.ndarray, hot2_n: np.ndarray) -> pa.Table:
    """Builds a shard's trie from the parts of all blocks and answers each part."""
    parts = [unpack(d.as_py()) for d in shard["data"]]
    tails = [from_five(p[11]) for p in parts]
    successors = lambda k: np.concatenate([t[p[k]] for t, p in zip(tails, parts)])
    whole = lambda k: np.concatenate([p[k] for p in parts])
    words, word_at = np.unique(whole(0), return_inverse=True)
    word_n = np.bincount(word_at, weights=whole(1)).astype(np.int64)
    contexts, at = np.unique(np.concatenate([np.concatenate([p[0], hot])[p[2]] for p in parts]), return_inverse=True)
    pair_context = np.repeat(at, whole(3))
    asked, pair_at = np.unique(pair_context.astype(np.uint64) << SUCC_BITS | successors(4), return_inverse=True)
    asked_n = np.bincount(pair_at, weights=whole(5), minlength=len(asked)).astype(np.int64)
    pair_cut = np.cumsum([0] + [len(p[5]) for p in parts])
    # Trigrams by the number of their bigram among those asked for; hot bigrams come after them.
    after = np.concatenate([x for k, p in enumerate(parts) for x in (
        np.repeat(pair_at[pair_cut[k]:pair_cut[k + 1]], p[6]), np.repeat(len(asked) + p[7].astype(np.int64), p[8]))])
    asked3, triple_at = np.unique(after.astype(np.uint64) << SUCC_BITS | successors(9), return_inverse=True)
    asked3_n = np.bincount(triple_at, weights=whole(10), minlength=len(asked3)).astype(np.int64)
    keys, pair_n = asked[asked_n > 0], asked_n[asked_n > 0]
    pair_context = (keys >> SUCC_BITS).astype(np.int64)
    # A context is followed by something as often as it occurs.
    context_n = np.bincount(pair_context, weights=pair_n, minlength=len(contexts))
    if len(hot):
        k = places(hot, contexts)
        context_n = np.where(k >= 0, hot_n[k], context_n)
    live = np.zeros(len(contexts), bool)
    live[pair_context] = True
    known = word_n > 0
    position = np.concatenate([np.cumsum(asked_n > 0) - 1, len(keys) + np.arange(len(hot2_n))])
    keys3 = asked3[asked3_n > 0]
    trie = Trie(words[known], word_n[known], contexts[live], context_n[live], (np.cumsum(live) - 1)[pair_context], keys & _SUCC_MASK, pair_n,
                hot2_n, position[(keys3 >> SUCC_BITS).astype(np.int64)], keys3 & _SUCC_MASK, asked3_n[asked3_n > 0])
    # What several blocks ask is asked once.
    word_reply = trie.words(words)
    none = np.empty(0, np.int64)
    sizes = np.bincount((asked >> SUCC_BITS).astype(np.int64), minlength=len(contexts))
    pairs = np.concatenate([none, *(trie.bigrams(contexts[a:b], sizes[a:b], asked[x:y] & _SUCC_MASK) for a, b, x, y in _stretches(sizes))])
    pair_reply, rest_reply = _said(trie.codes, pairs, 0), _said(trie.rest, pairs, 255)
    of = np.concatenate([pairs, len(keys) + np.arange(len(hot2_n))])
    sizes = np.bincount((asked3 >> SUCC_BITS).astype(np.int64), minlength=len(of))
    triples = np.concatenate([none, *(trie.trigrams(of[a:b], sizes[a:b], asked3[x:y] & _SUCC_MASK) for a, b, x, y in _stretches(sizes))])
    triple_reply = _said(trie.codes3, triples, 0)
    cut = lambda reply, at, k, i: reply[at[i[k]:i[k + 1]]]
    word_cut, triple_cut = (np.cumsum([0] + [len(p[c]) for p in parts]) for c in (0, 10))
    real = known & (words != np.uint64(_BEGIN))
    replies = [pack(cut(word_reply, word_at, k, word_cut), cut(pair_reply, pair_at, k, pair_cut), cut(rest_reply, pair_at, k, pair_cut),
                    cut(triple_reply, triple_at, k, triple_cut)) for k in range(len(parts))]
    first = [True] + [False] * (len(parts) - 1)
    return pa.table({"block": shard["block"], "shard": shard["shard"], "reply": pa.array(replies, pa.binary()),
                     "n": [int(word_n[real].sum()) if f else 0 for f in first], "v": [int(real.sum()) if f else 0 for f in first]})


def _said(codes: np.ndarray, at: np.ndarray, unknown: int) -> np.ndarray:
    """The codes at positions, another one for position -1."""
    return np.where(at >= 0, codes[at], np.uint8(unknown)) if len(codes) else np.full(len(at), unknown, np.uint8)


# --- 3: scores ----------------------------------------------------------------------
def scored(rows: pa.Table, replies: pa.Table, shards: int, hot: np.ndarray, hot2: np.ndarray, n: int, v: int) -> pa.Table:
    """Scores of the texts of one block."""
    block = Block(rows["data"][0].as_py(), train := rows["train"][0].as_py(), rows["sizes"][0].as_py(), shards, hot, hot2)
    word_n, codes3 = np.zeros(len(block.hashes), np.int64), np.zeros(len(block.triples), np.uint8)
    codes, rest = np.zeros(len(block.pairs), np.uint8), np.zeros(len(block.pairs), np.uint8)
    for s, reply in zip(replies["shard"].to_pylist(), replies["reply"].to_pylist()):
        word_n[block.words(s)], codes[block.bigrams(s)], rest[block.bigrams(s)], codes3[block.trigrams(s)] = unpack(reply)
    base = (word_n + 1) / (n + v + 1)
    first = np.concatenate([[0], np.cumsum(block.sizes)[:-1]])
    per_token = lambda x: np.add.reduceat(x, first)
    context = block.pairs >> 32
    p = (PROBABILITY[codes] + M / (word_n[context] + M) * base[block.pairs & 0xFFFFFFFF])[block.pair_of]
    # From the second token of a text on, two words stand before.
    p[block.inner] = PROBABILITY[codes3][block.triple_of] + PROBABILITY[rest][block.pair_of[block.inner - 1]] * p[block.inner]
    return pa.table({
        "doc_id": rows["ids"].combine_chunks().flatten(), "held_out": pa.array([not t for t in train]),
        "n_tokens": pa.array(block.sizes), "n_known": pa.array(per_token((word_n > 0)[block.tokens].astype(np.int64))),
        "train_tokens": pa.array(np.full(len(train), n)), "base_score": pa.array(per_token(np.log10(base)[block.tokens])),
        "score": pa.array(per_token(np.log10(p)))})


def lm_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all texts by the model learnt from those where ``train`` is true."""
    blocks = stage(blocks_of(docs.select(F.col(id_col).cast("long"), train, F.col(text_col).cast("binary"))), "lm-blocks")
    totals = blocks.agg(F.sum("trained"), F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")), F.sum(F.size(F.filter("train", lambda t: t)))).first()
    trained, tokens, texts = (x or 0 for x in totals)
    shards = max(LEAST_SHARDS, -(-tokens // SHARD_TOKENS))
    hot, hot_n = hot_words(blocks, trained)
    if texts * HOT > trained:
        # The begin of a text is a frequent context as well.
        at = np.searchsorted(hot, np.uint64(_BEGIN))
        hot, hot_n = np.insert(hot, at, np.uint64(_BEGIN)), np.insert(hot_n, at, texts)
    hot2, hot2_n = hot_pairs(blocks, hot, trained)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, train, sizes, data = (batch.column(c)[i].as_py() for c in range(4))
                block = Block(data, train, sizes, shards, hot, hot2)
                for s in block.shards():
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([s], pa.int32()), pa.array([block.part(s)], pa.binary())],
                                                     ["block", "shard", "data"])

    sent = blocks.select("block", "train", "sizes", "data").mapInArrow(parts, "block long, shard int, data binary")

    def build(shard: pa.Table) -> pa.Table:
        return answered(shard, hot, hot_n, hot2_n)

    replies = stage(sent.groupBy("shard").applyInArrow(build, "block long, shard int, reply binary, n long, v long"), "lm-replies")
    n, v = (x or 0 for x in replies.agg(F.sum("n"), F.sum("v")).first())

    def score(rows: pa.Table, got: pa.Table) -> pa.Table:
        return scored(rows, got, shards, hot, hot2, n, v)

    return (blocks.select("block", "ids", "train", "sizes", "data").groupBy("block")
            .cogroup(replies.select("block", "shard", "reply").groupBy("block"))
            .applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), ~held_out())
