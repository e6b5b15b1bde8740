"""Language identification in two steps.

Texts are described by hashed letter n-grams (1 to 3) of the whole text. First
the language family is predicted, then one-versus-one linear support vector
machines decide between the languages of that family. Families are found in
the data: languages whose mean descriptions are closest are put together.

Learning uses a bounded sample of labelled rows (``SAMPLE`` in all, chosen by a
hash of the id); their descriptions, a few kB each, are computed where the rows
are and the machines fitted on the driver. Prediction reads every whole text.

Defined results: ``und`` with score 0 for a null text or one without a letter;
rows without a label are not learnt from; if nothing can be learnt (an empty
table, no labels) every text is ``und``; with one language all texts with a
letter get it; a null id counts as held out by no one and is learnt from never;
repeated rows repeat their result. Only id, text and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import table

#: Labelled rows learnt from in all, and the least for one language.
SAMPLE, LEAST = 3000, 100
DIMS = 4096
EPOCHS, COST = 12, 1.0
#: Characters described at a time.
PIECE = 1 << 18
UND = "und"

_LETTER = np.zeros(0x110000, dtype=bool)


def _letters() -> np.ndarray:
    if not _LETTER.any():
        _LETTER[:] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def _grams(c: np.ndarray, old: int) -> np.ndarray:
    """Counts of the n-grams that end behind the first ``old`` symbols of ``c``."""
    one = c * np.uint64(0x9E3779B97F4A7C15)
    two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + one[2:]
    shift = np.uint64(64 - DIMS.bit_length() + 1)
    fresh = (one[old:], two[max(0, old - 1):], three[max(0, old - 2):])
    where = np.concatenate([(x * np.uint64(0xD6E8FEB86659FD93)) >> shift for x in fresh])
    return np.bincount(where.astype(np.int64), minlength=DIMS)


def describe(text: str | None) -> np.ndarray | None:
    """Unit vector of a text, or None without a letter. Long texts go through in pieces."""
    if not text:
        return None
    text, counts, found = text.lower(), np.zeros(DIMS, dtype=np.int64), False
    # Letters as they are, each run of other characters as one 0, and a 0 at both ends.
    c, old, after_letter = np.zeros(1, dtype=np.uint64), 0, False
    for start in range(0, len(text), PIECE):
        codes = np.frombuffer(text[start:start + PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= after_letter
        after_letter, found = letter[-1], found or bool(letter.any())
        c = np.concatenate([c, np.where(letter, codes, 0)[keep].astype(np.uint64)])
        counts += _grams(c, old)
        c = c[-2:]
        old = len(c)
    if not found:
        return None
    counts += _grams(np.append(c, np.uint64(0)), old)
    v = np.log1p(counts).astype(np.float32)
    return v / np.sqrt((v * v).sum())


def fit_svm(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, cost: float = COST) -> np.ndarray:
    """Weights (the last is the bias) of a linear SVM by dual coordinate descent; y is +1 or -1."""
    norm = np.einsum("ij,ij->i", x, x) + 1
    # Both sides weigh the same, whatever their number.
    limit = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    alpha, w, rng = np.zeros(len(y)), np.zeros(x.shape[1] + 1), np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            g = y[i] * (x[i] @ w[:-1] + w[-1]) - 1
            a = min(max(alpha[i] - g / norm[i], 0.0), limit[i])
            if a != alpha[i]:
                w[:-1] += (a - alpha[i]) * y[i] * x[i]
                w[-1] += (a - alpha[i]) * y[i]
                alpha[i] = a
    return w.astype(np.float32)


@dataclass
class Model:
    families: list[list[str]] = field(default_factory=list)
    family_w: np.ndarray | None = None
    pair_w: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, v: np.ndarray | None) -> tuple[str, float]:
        if v is None or not self.families:
            return UND, 0.0
        sure = lambda m: 1 / (1 + np.exp(-2 * float(m)))
        v = np.append(v, np.float32(1))
        best, p = 0, 1.0
        if len(self.families) > 1:
            margins = self.family_w @ v
            best = int(margins.argmax())
            p = sure(margins[best])
        langs = self.families[best]
        if len(langs) == 1:
            return langs[0], p
        votes, trust = dict.fromkeys(langs, 0), {a: [] for a in langs}
        for (a, b), w in self.pair_w.items():
            if a in votes and b in votes:
                m = w @ v
                votes[a if m >= 0 else b] += 1
                trust[a].append(sure(m))
                trust[b].append(sure(-m))
        lang = max(langs, key=lambda a: (votes[a], sum(trust[a])))
        return lang, p * sum(trust[lang]) / len(trust[lang])


def families_of(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Closest languages joined (mean cosine) until about the root of their number of families is left."""
    groups = [[a] for a in sorted(means)]
    unit = {a: m / (np.linalg.norm(m) or 1) for a, m in means.items()}
    centre = np.mean(list(unit.values()), axis=0) if unit else None
    unit = {a: (m - centre) for a, m in unit.items()}
    unit = {a: m / (np.linalg.norm(m) or 1) for a, m in unit.items()}
    while len(groups) > max(1, round(len(means) ** 0.5)):
        near = lambda i, j: np.mean([unit[a] @ unit[b] for a in groups[i] for b in groups[j]])
        i, j = max(((i, j) for i in range(len(groups)) for j in range(i + 1, len(groups))), key=lambda p: near(*p))
        groups[i] += groups.pop(j)
    return groups


def fit(x: np.ndarray, langs: np.ndarray) -> Model:
    names = sorted(set(langs))
    groups = families_of({a: x[langs == a].mean(axis=0) for a in names})
    home = {a: k for k, g in enumerate(groups) for a in g}
    family = np.array([home[a] for a in langs], dtype=int)
    model = Model(groups)
    if len(groups) > 1:
        model.family_w = np.stack([fit_svm(x, np.where(family == k, 1.0, -1.0)) for k in range(len(groups))])
    for g in groups:
        for i, a in enumerate(g):
            for b in g[i + 1:]:
                rows = (langs == a) | (langs == b)
                model.pair_w[a, b] = fit_svm(x[rows], np.where(langs[rows] == a, 1.0, -1.0))
    return model


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    found = {r[0]: r[1] for r in known.groupBy(lang_col).agg(F.count(F.lit(1))).collect()}
    if not found:
        return Model()
    each = max(LEAST, SAMPLE // len(found))
    draw = F.pmod(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[F.lit(z) for a, n in found.items() for z in (a, min(1.0, each / n))]), F.col(lang_col))
    sample = known.where(draw < share).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(describe(t), a) for t, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            kept = [(v.astype(np.float16).tobytes(), a) for v, a in pairs if v is not None]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in kept], pa.binary()), pa.array([a for _, a in kept])], ["v", "lang"])

    rows = sample.mapInArrow(run, "v binary, lang string").toArrow()
    if not rows.num_rows:
        return Model()
    rows = sorted(zip(rows["lang"].to_pylist(), rows["v"].to_pylist()))  # the same model whatever the order of tasks
    x = np.stack([np.frombuffer(v, dtype=np.float16) for _, v in rows]).astype(np.float32)
    return fit(x, np.array([a for a, _ in rows], dtype=object))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score. Only the text crosses to Python."""
    from pyspark.sql.pandas.functions import arrow_udf

    @arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        out = [model.predict(describe(t.as_py())) for t in texts]
        return pa.StructArray.from_arrays([pa.array([a for a, _ in out], pa.string()), pa.array([p for _, p in out], pa.float64())],
                                          ["lang_pred", "score"])

    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "__lid")]
    said = docs.select(*keep, predict(F.col(text_col)).alias("__lid"))
    return said.select(*keep, "__lid.lang_pred", "__lid.score")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language can be told, all columns kept."""
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "__lid")]
    said = identify(docs.select(*own), learn(docs, id_col, text_col, lang_col), text_col)
    return said.where(F.col("lang_pred") != UND).select(*own)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    said = identify(docs.select("doc_id", "text"), learn(docs))
    return said.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
