"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut where its pieces cannot cross (before a run of word marks), and
each distinct pre-token is merged once per batch of pre-tokens: the symbols of
all pre-tokens lie in one array with offsets, cut further where no piece holds
the two characters side by side. In each round every sequence that still has a
known pair merges its best-ranked one, at all places that one merge after the
other, from the left, would come to: places that do not overlap. Where a new
symbol makes a pair as good or better with a neighbour (runs of spaces do), the
sequence is walked from the left once, and the new symbol grows first. What
survives is counted. Symbols that are no piece count as their UTF-8 bytes (byte
fallback). Pre-tokens of any length go this way. Counts of short pre-tokens are
remembered in the worker up to a fixed number of entries, so a text costs
look-ups only.

Defined results: a null text counts as empty and has no token; texts are
processed whole, in any length; characters that stand for the word mark itself
are treated as the library does, as word marks; rows are independent, so
repeated rows repeat their result; empty tables give empty results. Only id
and text are read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import byte_sizes, portions, table

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Pre-tokens remembered by a worker, and the most code points of one that is
#: remembered (about 100 bytes an entry).
MEMORY, SHORT = 300_000, 64
#: Symbols merged in one array (a sequence that is longer goes whole).
PORTION = 1_000_000
MARK = "▁"
PRETOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Merger:
    """Counts tokens of pre-tokens with the pieces and ranks of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_unknown(i) or model.is_control(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        # Rank 0 is the best score; equal scores share a rank.
        order = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        self.rank = {i: order[model.get_score(i)] for i in plain}
        # Every way to make a piece of two pieces: (left, right) -> (rank, piece).
        pairs = []
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, self.rank[i], i))
        pairs.sort()
        self.keys = np.array([p[0] for p in pairs], dtype=np.int64)
        self.ranks = np.array([p[1] for p in pairs], dtype=np.int64)
        self.made = np.array([p[2] for p in pairs], dtype=np.int64)
        self.pairs = {p[0]: (p[1], p[2]) for p in pairs}
        # The symbol of each character; one that is no piece has minus its bytes.
        points = np.arange(sys.maxunicode + 1)
        self.symbols = -1 - (points >= 0x80).astype(np.int64) - (points >= 0x800) - (points >= 0x10000)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        # Characters side by side in any piece.
        self.beside = np.array(sorted({ord(x) << 32 | ord(y) for p in self.ids for x, y in zip(p, p[1:])}), dtype=np.int64)
        self.known: dict[str, int] = {}

    NONE = np.int64(1) << 40

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], self.NONE), self.made[at]

    def count(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word (no word is empty)."""
        total = np.zeros(len(words), dtype=np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        if not len(codes):
            return total
        word = np.repeat(np.arange(len(words)), lengths)
        key = codes[:-1] << 32 | codes[1:]
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        begins = np.r_[True, (word[1:] != word[:-1]) | (self.beside[at] != key)]
        starts = np.flatnonzero(begins)
        cuts = np.unique(starts[np.searchsorted(starts, np.arange(0, len(codes), PORTION), side="right") - 1])
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(codes)]):
            self._merge(self.symbols[codes[lo:hi]], word[lo:hi], np.cumsum(begins[lo:hi]), total)
        return total

    def _merge(self, symbols: np.ndarray, word: np.ndarray, part: np.ndarray, total: np.ndarray) -> None:
        """Merges the sequences numbered by ``part`` and adds what survives to the totals of their words."""
        rank = np.full(len(symbols), self.NONE)
        made = np.zeros(len(symbols), dtype=np.int64)

        def look_up_at(at: np.ndarray) -> None:
            """Ranks of the pairs that begin at these places."""
            rank[at] = self.NONE
            at = at[at + 1 < len(symbols)]
            at = at[part[at] == part[at + 1]]
            rank[at], made[at] = self._look_up(symbols[at], symbols[at + 1])

        look_up_at(np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            best = np.minimum.reduceat(rank, first)
            level = np.repeat(best, np.diff(np.r_[first, len(symbols)]))
            keep = level < self.NONE
            done = ~keep
            if done.any():
                np.add.at(total, word[done], np.where(symbols[done] < 0, -symbols[done], 1))
            where = np.flatnonzero(keep & (rank == level))
            if not len(where):
                return
            # Of hits that overlap, every second one, from the left.
            nth = np.arange(len(where))
            run = np.maximum.accumulate(np.where(np.r_[True, np.diff(where) != 1], nth, 0))
            where = where[(nth - run) % 2 == 0]
            moved = self._disturbed(where, symbols, part, made, level)
            changed = [np.empty(0, dtype=np.int64)]
            if len(moved):
                where = where[~np.isin(part[where], moved)]
                for lo in first[np.isin(part[first], moved)]:
                    hi = np.searchsorted(part, part[lo], side="right")
                    walked = self._walked(symbols[lo:hi].tolist(), rank[lo:hi].tolist(), made[lo:hi].tolist(), int(level[lo]))
                    symbols[lo:lo + len(walked)] = walked
                    keep[lo + len(walked):hi] = False
                    changed.append(np.arange(lo, lo + len(walked)))
            symbols[where] = made[where]
            keep[where + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, part, rank, made = symbols[keep], word[keep], part[keep], rank[keep], made[keep]
            new = place[where]
            look_up_at(np.concatenate([new, new[new > 0] - 1, place[np.concatenate(changed)]]))

    def _disturbed(self, where: np.ndarray, symbols: np.ndarray, part: np.ndarray, made: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The sequences in which a merge makes a pair as good as the round's or better."""
        new = made[where]
        left = np.where(where > 0, symbols[where - 1], -1)
        left[1:] = np.where(where[1:] == where[:-1] + 2, new[:-1], left[1:])
        left[(where > 0) & (part[where - 1] != part[where])] = -1
        after = np.minimum(where + 2, len(symbols) - 1)
        right = np.where((where + 2 < len(symbols)) & (part[after] == part[where]), symbols[after], -1)
        arises = np.minimum(self._look_up(left, new)[0], self._look_up(new, right)[0]) <= level[where]
        return np.unique(part[where[arises]])

    def _walked(self, symbols: list[int], rank: list[int], made: list[int], level: int) -> list[int]:
        """A sequence after all merges up to a rank, none of which is below it at first."""
        none = (int(self.NONE), 0)
        out: list[int] = []
        i, n = 0, len(symbols)
        while i < n:
            if rank[i] != level:
                out.append(symbols[i])
                i += 1
                continue
            grown = made[i]
            i += 2
            while True:
                left = self.pairs.get(out[-1] << 32 | grown, none) if out and out[-1] >= 0 else none
                right = self.pairs.get(grown << 32 | symbols[i], none) if i < n and symbols[i] >= 0 else none
                if min(left[0], right[0]) > level:
                    break
                if left[0] <= right[0]:
                    grown = left[1]
                    out.pop()
                else:
                    grown = right[1]
                    i += 1
            out.append(grown)
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each whole text."""
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        cut = [PRETOKEN.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = [w for w in {w for words in cut for w in words} if w not in known]
        long: dict[str, int] = {}
        for w, n in zip(new, self.count(new).tolist()):
            (known if len(w) <= SHORT else long)[w] = n
        return [sum(map(known.__getitem__, words)) if not long else
                sum(known[w] if w in known else long[w] for w in words) for words in cut]


_MERGERS: dict[str, Merger] = {}


def _merger(name: str) -> Merger:
    """The model of this worker; tokenizer files are installed with the library on every node."""
    if name not in _MERGERS:
        import public_tokenizers

        _MERGERS[name] = Merger(public_tokenizers.path(name))
    return _MERGERS[name]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_tokens, over_limit."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(model)
        for batch in batches:
            for part in portions(batch, 1):
                counts = merger.counts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(byte_sizes(part.column(1))), pa.array(counts, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    out = slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
