"""Benchmark decontamination by templates.

Words are brought to a canonical form: punctuation at the ends goes, letters
are lower-cased, numbers, units after a number and names (capitalised inside a
sentence) become typed placeholders whose values are kept as slots. A second
form leaves names as words, so that a text in title case still matches. A third
one takes capitalised words at the beginning of a sentence for names, too, so
that a sentence that begins with another person's name does. Windows
of ``WIDTH`` canonical words of the documents are hash-joined with those of the
benchmark items. The slots of a document and an item must be consistent: one
value of the item always stands for one value of the document, and one of the
document for one of the item. Within an alignment (matches at one distance),
windows that hold a value with several partners do not count, unless all their
slots equal the item's. Then alignments are taken from the largest down, and of
each the windows that agree with all taken before, or equal the item. So a
question with other numbers or names in it is found, also with words put in; a
chance match of templates and sentences with values of their own are not; and
one changed value does not hide the verbatim rest.

A document is contaminated by an item if the windows that are left cover
``COVERAGE`` of the item's windows, or ``RUN`` words in a row (counted over the
windows that are used). Both are judged per form, relative to the windows that
this form can use, and the better form counts: windows with enough plain words
only while names are words cannot match a copy with other names.

Only windows of a document that occur in the benchmark leave the scan: the
benchmark's window hashes go to the tasks if there are at most ``MOST_HASHES``
(32 MB); with a larger benchmark all windows go to the join, with equal result.

Defined results: null and empty texts match nothing and are clean; windows with
fewer than ``LITERALS`` plain words are not used as templates; an item without
any other, or mostly in a script without spaces, is looked for by exact windows:
words as they are with numbers, signs and operators, words of such scripts and
words of over ``LONG`` characters character by character (a run is then twice as
long). An item of fewer than ``LEAST_EXACT`` words would take every text with them
and is not looked for (``unsearched`` lists such items); an item shorter than a
window is one window of its own length;
items with equal texts are reported each, items
without an id are not named, but their texts still are contamination; rows with a null id are judged like
others; repeated rows repeat their result; with an empty benchmark all is
clean. Only the id and text columns of both tables are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import flat, portions, stage, table

WIDTH, LITERALS, COVERAGE, RUN = 5, 3, 0.8, 13
MOST_HASHES = 4_000_000
#: Canonical forms remembered by a worker.
MEMORY = 400_000
#: Characters of a word that is compared character by character.
LONG = 40
#: Words (characters in scripts without spaces) that an item has at least to be looked for by exact windows.
LEAST_EXACT = 2

# Units of measure, and number words.
UNITS = frozenset(
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms oz ounce ounces "
    "lb lbs pound pounds ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours "
    "day days week weeks month months year years percent dollar dollars usd euro euros eur cent cents degree degrees "
    "meter meters metre metres kilometer kilometers kilometre kilometres kmh mph watt watts volt volts".split())
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty hundred thousand million".split())

LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
_NUMERIC = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*%?")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_MARKS = re.compile(r"^[\"'“”‘’«¿¡(\[{]+|[\"'“”‘’».,;:!?…)\]}]+$")
# Thai, Lao, Tibetan, Burmese, Khmer, kana and Han, and the punctuation of the last two.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_PAUSES = re.compile("[\u3000-\u3003\u3008-\u3011\u2018-\u201d\u2026\uff01\uff08\uff09\uff0c\uff0e\uff1a\uff1b\uff1f]+")
_P = np.uint64(0x9E3779B97F4A7C15)
_EXACT = np.uint64(0xC2B2AE3D27D4EB4F)
_ENDS = (".", "!", "?", ":", ";", "|", "-")
_TYPE = np.array([0, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93], dtype=np.uint64)


class _Known(dict):
    """Raw words seen so far; one that is new is added."""

    def __init__(self, add):
        super().__init__()
        self.add = add

    def __missing__(self, raw: bytes) -> int:
        return self.add(raw)


class Forms:
    """Per raw word: hash of its canonical form, its kind, and what it says of its place."""

    def __init__(self):
        self.index = _Known(self.add)
        self.hashes = np.zeros(1024, dtype=np.uint64)
        self.flags = np.zeros(1024, dtype=np.uint8)  # kind, + 4 ends a sentence, + 8 a real word

    def add(self, raw: bytes) -> int:
        text = raw.decode("utf-8", "replace")
        plain = text.isalpha()
        core = text if plain else _EDGE.sub("", text)
        low = core.lower()
        kind = NUMBER if low in NUMBERS or not plain and _NUMERIC.fullmatch(core) else UNIT if low in UNITS else LITERAL
        if kind == LITERAL and core[:1].isupper():  # Anna, ANNA, O'Brien, J.
            kind = NAME
        at = len(self.index)
        if at == len(self.hashes):
            self.hashes, self.flags = np.resize(self.hashes, 2 * at), np.resize(self.flags, 2 * at)
        self.hashes[at] = xxhash.xxh3_64_intdigest(low.encode("utf-8", "replace"))
        self.flags[at] = kind | (8 if core else 0) | (4 if not core or not plain and text.endswith(_ENDS) else 0)
        self.index[raw] = at
        return at

    def of(self, text: bytes | None) -> tuple[np.ndarray, ...]:
        """Of a whole text: hashes, kinds and, where these differ, kinds with names
        as words and kinds with every capitalised word as a name."""
        words = text.split() if text else []
        if len(self.index) > MEMORY:
            self.index.clear()
        ids = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        h, flags = self.hashes[ids], self.flags[ids]
        names, real = flags & 3, flags >= 8
        if not names.any():
            return h[real] if not real.all() else h, names[real]
        fresh = np.ones(len(ids), dtype=bool)  # begins a sentence
        fresh[1:] = flags[:-1] & 4 > 0
        if not real.all():
            h, names, fresh = h[real], names[real], fresh[real]
        after_number = np.zeros(len(names), dtype=bool)
        after_number[1:] = names[:-1] == NUMBER
        names[(names == UNIT) & ~after_number] = LITERAL
        name = names == NAME
        out = [h, np.where(name & fresh, LITERAL, names)]
        if (name & ~fresh).any():
            out.append(np.where(name, LITERAL, names))
        if (name & fresh).any():
            out.append(names)
        return tuple(out)


class Tokens:
    """Hashes of words as they are, without sentence punctuation at their ends;
    words without spaces between them, and very long ones, as characters."""

    def __init__(self):
        self.index: dict[bytes, int] = {}

    def add(self, raw: bytes) -> int | np.ndarray:
        low = raw.decode("utf-8", "replace").lower()
        if len(low) > LONG or not low.isascii() and _UNSPACED.search(low):
            c = np.frombuffer(_MARKS.sub("", _PAUSES.sub("", low)).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
            c = (c + np.uint64(1)) * _P
            return (c ^ c >> np.uint64(29)) * _P
        x = self.index[raw] = xxhash.xxh3_64_intdigest((_MARKS.sub("", low) or low).encode()) or 1
        return x

    def of(self, text: bytes | None) -> tuple[np.ndarray, int]:
        """(hashes of a whole text, how many are of characters)."""
        if len(self.index) > MEMORY:
            self.index.clear()
        got = [self.index.get(w) or self.add(w) for w in (text.split() if text else [])]
        long = [x for x in got if not isinstance(x, int)]
        if not long:
            return np.array(got, dtype=np.uint64), 0
        parts, words = [], []
        for x in got:
            if isinstance(x, int):
                words.append(x)
            else:
                parts += [np.array(words, dtype=np.uint64), x]
                words = []
        return np.concatenate([*parts, np.array(words, dtype=np.uint64)]), sum(map(len, long))


def windows(h: np.ndarray, kind: np.ndarray, width: int, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the windows with enough plain words; with ``other`` (kinds
    of another form) only of those that differ from that form's."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    typed = bool(kind.any())
    code = np.where(kind == LITERAL, h, _TYPE[kind]) if typed else h
    at = None
    if other is not None:
        differs = np.cumsum(np.concatenate([[0], kind != other]))
        at = np.flatnonzero(differs[width:] > differs[:n])
    if typed:
        plain = np.cumsum(np.concatenate([[0], kind == LITERAL]))
        enough = plain[width:] - plain[:n] >= min(LITERALS, width)
        at = at[enough[at]] if at is not None else np.flatnonzero(enough)
    few = at is not None and 2 * len(at) < n
    out = (code[at] if few else code[:n]) + np.uint64(width)
    for k in range(1, width):
        out *= _P
        out += code[at + k] if few else code[k:k + n]
    out ^= out >> np.uint64(29)
    out *= _P
    out ^= out >> np.uint64(32)
    return (np.arange(n), out) if at is None else (at, out if few else out[at])


def exact_windows(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of all windows, apart from those of templates."""
    at, hashes = windows(h, np.zeros(len(h), dtype=np.uint8), width)
    return at, hashes ^ _EXACT


def found(text: bytes | None, widths: list[int], wanted) -> Iterator[tuple[int, int, list[int]]]:
    """(start, hash, slots) of the wanted windows of a text, in each of its forms; widths below 0 are of exact windows."""
    h, typed, *others = _FORMS.of(text)
    for width in widths:
        if width < 0:
            continue
        for kind in (typed, *others):
            at, hashes = windows(h, kind, width, None if kind is typed else typed)
            hit = wanted(hashes)
            for s, x in zip(at[hit].tolist(), hashes[hit].view(np.int64).tolist()):
                slots = h[s:s + width][kind[s:s + width] != LITERAL]
                yield s, x, slots.view(np.int64).tolist()
    exact = [-width for width in widths if width < 0]
    if exact:
        h, _ = _TOKENS.of(text)
    for width in exact:
        at, hashes = exact_windows(h, width)
        hit = wanted(hashes)
        at, hashes = at[hit], hashes[hit]
        if width < WIDTH:  # whole items: once a text is enough
            hashes, first = np.unique(hashes, return_index=True)
            at = at[first]
        for s, x in zip(at.tolist(), hashes.view(np.int64).tolist()):
            yield s, x, []


def cut(text: bytes | None) -> Iterator[tuple[int, int, int, list[int], list[int | None], list[int], int]]:
    """(width, start, hash, slots, ranks, counts, run) of the windows of an item: at
    full width, or for a shorter item its one whole window. ``ranks`` has the
    window's place among those each form can use, ``counts`` how many these are,
    ``run`` is the length of run that is enough; exact windows have widths below 0."""
    h, typed, *others = _FORMS.of(text)
    width = min(WIDTH, len(h))
    forms_at = [windows(h, kind, width)[0].tolist() for kind in (typed, *others)] if width >= LITERALS else []
    ranks = [{s: n for n, s in enumerate(at)} for at in forms_at if at]
    counts = [len(r) for r in ranks]
    if ranks:
        for s, x, slots in found(text, [width], lambda x: np.arange(len(x))):
            yield width, s, x, slots, [r.get(s) for r in ranks], counts, RUN
    h, characters = _TOKENS.of(text)
    unspaced = 2 * characters >= len(h)
    if len(h) >= LEAST_EXACT and (unspaced or not ranks):
        width = min(WIDTH, len(h))
        at, hashes = exact_windows(h, width)
        for s, x in zip(at.tolist(), hashes.view(np.int64).tolist()):
            yield -width, s, x, [], [s], [len(at)], 2 * RUN if unspaced else RUN


_FORMS, _TOKENS = Forms(), Tokens()
_SCHEMA = "id long, mark long, at int, hash long, slots array<long>"
_CUTS = ("item long, item_mark long, width int, item_at int, hash long, item_slots array<long>, "
         "ranks array<int>, counts array<int>, enough int")


def item_windows(items: DataFrame) -> DataFrame:
    """Windows of the (id, mark, text) rows of the benchmark, each item once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), ints, ints, pa.int32())
        names = [c.split()[0] for c in _CUTS.split(", ")]
        for batch in batches:
            for part in portions(batch, 2):
                out = [(i, mark, *w) for i, mark, text in zip(*(c.to_pylist() for c in part.columns)) for w in cut(text)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return items.dropDuplicates(["id", "mark"]).mapInArrow(run, _CUTS)


def unsearched(bench: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, text) of the items that are too short to be looked for."""
    items = _rows(bench, item_col, item_text_col).dropDuplicates(["id", "mark"])
    cuts = item_windows(items).select(F.col("item"), "item_mark").distinct()
    left = items.join(cuts, F.col("id").eqNullSafe(F.col("item")) & (F.col("mark") == F.col("item_mark")), "left_anti")
    return left.select(F.col("id").alias("item_id"), F.col("text").cast("string").alias("text"))


def matched(rows: DataFrame, widths: list[int], hashes: np.ndarray | None) -> DataFrame:
    """Windows of (id, mark, text) rows; with ``hashes`` (sorted) only those in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if hashes is not None:
            sieve = np.zeros(1 << 22, dtype=bool)
            sieve[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

        def wanted(x: np.ndarray) -> np.ndarray:
            if hashes is None:
                return np.arange(len(x))
            near = np.flatnonzero(sieve[(x & np.uint64((1 << 22) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(hashes, x[near]), len(hashes) - 1)
            return near[hashes[at] == x[near]]

        for batch in batches:
            for part in portions(batch, 2):
                out: list[tuple] = []
                for i, mark, text in zip(*(c.to_pylist() for c in part.columns)):
                    out += [(i, mark, *w) for w in found(text, widths, wanted)]
                if out:
                    cols = list(zip(*out))
                    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["id", "mark", "at", "hash", "slots"])

    return rows.mapInArrow(run, _SCHEMA)


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).cast("binary").alias("text"))


def leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Staged contaminated rows: __id, __mark (hash of the text), item_ids, coverage (of the best item)."""
    items = _rows(bench, item_col, item_text_col)
    cuts = stage(item_windows(items), "bench-windows")
    widths = sorted(r[0] for r in cuts.select("width").distinct().collect())
    n = cuts.count()
    hashes = None
    if n <= MOST_HASHES:
        got = cuts.select("hash").distinct().toArrow()["hash"].to_numpy().view(np.uint64)
        hashes = np.sort(got) if len(got) else np.array([0], dtype=np.uint64)

    rows = _rows(docs, id_col, text_col)
    hits = matched(rows, widths, hashes).join(cuts, "hash")
    # Sets because a window may match in more than one form.
    pairs = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    lines = (hits.select("id", "mark", "item", "item_mark", "width", "counts", "enough", (F.col("at") - F.col("item_at")).alias("line"),
                         F.struct("item_at", "ranks", pairs.alias("p")).alias("w"))
             .groupBy("id", "mark", "item", "item_mark", "width", "enough", "line").agg(F.array_sort(F.collect_set("w")).alias("ws"), F.first("counts").alias("counts"))
             .withColumn("p", F.array_sort(F.array_distinct(F.flatten(F.transform("ws", lambda w: w["p"]))))))
    # Values with more than one partner in the line: neighbours in the pairs sorted by either side.
    def torn(pairs, side: str, other: str):
        by = F.array_sort(F.transform(pairs, lambda x: F.struct(x[side].alias("a"), x[other].alias("b"))))
        two = F.zip_with(by, F.slice(by, F.lit(2), F.size(by)), lambda x, y: F.when(x["a"] == y["a"], x["a"]))
        return F.filter(two, lambda x: x.isNotNull())

    equal = lambda w: F.forall(w["p"], lambda x: x["i"] == x["d"])
    holds = lambda w: ~F.exists(w["p"], lambda x: F.array_contains("torn_i", x["i"]) | F.array_contains("torn_d", x["d"])) | equal(w)
    lines = (lines.withColumns({"torn_i": torn("p", "i", "d"), "torn_d": torn("p", "d", "i")})
             .withColumn("ws", F.when((F.size("torn_i") == 0) & (F.size("torn_d") == 0), F.col("ws")).otherwise(F.filter("ws", holds))))
    # Lines of equal windows (a passage that the text repeats) count once; the largest lines come first.
    each = F.struct((-F.size("ws")).alias("n"), F.col("ws").alias("ws"))
    lines = (lines.where(F.size("ws") > 0).groupBy("id", "mark", "item", "item_mark", "width", "enough")
             .agg(F.array_sort(F.collect_set(each)).alias("lines"), F.first("counts").alias("counts")))
    # A line's windows that agree with the pairs taken so far.
    agrees = lambda w, pairs: equal(w) | ~F.exists(
        w["p"], lambda x: F.exists(pairs, lambda y: (x["i"] == y["i"]) != (x["d"] == y["d"])))
    slim = lambda ws: F.array_distinct(F.transform(ws, lambda w: F.struct(w["item_at"].alias("item_at"), w["ranks"].alias("ranks"))))
    took = lambda a, ws: F.struct(
        F.array_union(a["pairs"], F.array_distinct(F.flatten(F.transform(ws, lambda w: w["p"])))).alias("pairs"),
        F.concat(a["lines"], F.array(slim(ws))).alias("lines"))
    none = F.struct(F.array().cast("array<struct<i:bigint,d:bigint>>").alias("pairs"),
                    F.array().cast("array<array<struct<item_at:int,ranks:array<int>>>>").alias("lines"))
    lines = lines.withColumn("lines", F.aggregate(
        "lines", none, lambda a, l: took(a, F.filter(l["ws"], lambda w: agrees(w, a["pairs"]))), lambda a: a["lines"]))
    # Per form of the item, the windows that it can use, whatever form they matched in.
    usable = lambda f, ws: F.filter(ws, lambda w: F.get(w["ranks"], f).isNotNull())
    per_form = lambda judge: F.array_max(F.transform(F.sequence(F.lit(0), F.size("counts") - 1), judge))
    # Words of the longest run of usable windows that follow each other in the item.
    begins = lambda f, a, x: F.when(F.get(x["ranks"], f) == a["last"] + 1, a["begin"]).otherwise(x["item_at"])
    run = lambda f, ws: F.aggregate(
        ws, F.struct(F.lit(-9).alias("last"), F.lit(0).alias("begin"), F.lit(0).alias("best")),
        lambda a, x: F.struct(F.get(x["ranks"], f).alias("last"), begins(f, a, x).alias("begin"),
                              F.greatest(a["best"], x["item_at"] - begins(f, a, x) + WIDTH).alias("best")), lambda a: a["best"])
    per_item = (lines.withColumn("ws", F.array_distinct(F.flatten("lines")))
                .withColumn("run", per_form(lambda f: F.array_max(F.transform("lines", lambda ws: run(f, usable(f, ws))))))
                .withColumn("coverage", per_form(lambda f: F.size(usable(f, F.col("ws"))) / F.get("counts", f))))
    long_run = (F.abs("width") == WIDTH) & (F.col("run") >= F.col("enough"))
    bad = (per_item.where((F.col("coverage") >= COVERAGE) | long_run).groupBy("id", "mark")
           .agg(F.array_sort(F.collect_set("item")).alias("item_ids"), F.max("coverage").alias("coverage")))
    return stage(bad.toDF("__id", "__mark", "item_ids", "coverage"), "contaminated")


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """One row a document: doc_id, contaminated, item_ids, coverage."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark"))
    out = rows.join(leaks(docs, bench, id_col, text_col, **columns), same, "left")
    return out.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
                      F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
                      F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def decontaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """The clean rows of ``docs``, all columns kept."""
    rows, back, (id_, text) = flat(docs, id_col, text_col)
    same = F.col(id_).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__mark"))
    return rows.join(leaks(docs, bench, id_col, text_col, **columns), same, "left_anti").select(*back)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids"), "coverage")
