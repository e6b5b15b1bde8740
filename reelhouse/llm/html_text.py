"""Main text of web pages, with a suffix array for each host.

1. A page is cut into blocks. Elements say what a block is: part of the article
   (``article``, ``main``), furniture (``nav``, ``footer``, ``aside``, ``form``, a class
   such as ``ad`` or ``comments``), or neither: open. Scripts, styles and markup
   are no text at all.
2. All blocks outside articles are the page's token stream: for each block its
   tag, then its words; where an article lies is a gap. Streams of a host are
   concatenated, as many pages as fit a shard, and their suffixes sorted by
   prefix doubling, as deep as ``RUN`` tokens. Neighbours that agree so far and come
   from pages with different content are repeats; tokens in a repeat are covered.
3. A host may take many shards. Runs that a shard of such a host has are held
   against those of its other shards by one aggregate over (host, run), so a
   repeat is found wherever its copies lie, in a host of any size.
4. The articles of a host have suffix arrays of their own, apart from the streams,
   cut into shards by article. Articles quote each other, so a repeat alone says
   nothing there: a run is a notice if more than half of the host's different
   articles hold it, ``LEAST`` at least. These arrays take 16 bits of a word's hash; a run
   that half of a shard's articles hold is then counted over the whole host by 64 bits.
5. A page with an article gives the article's blocks, without furniture in it and
   without notices. Other pages give the unique runs of their open blocks; what
   repeats across pages of the host is boilerplate, marked or not.

Defined results: null, empty and pure markup pages give the empty text; pages
with equal content count as one page, so copies of a page do not remove each
other; rows that repeat give rows that repeat; a null or odd url is the host "";
an empty table gives an empty result. Only id, url and html are read. White space
is that of ``str.split``. Words are told apart by 64-bit hashes, runs of other shards
by one of 64 bits more.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import portions, stage, table

#: Tokens that a repeat has at least (a power of two), tokens to a shard, stream tokens to a range of hosts,
#: different articles that hold a notice at least.
RUN, SHARD_TOKENS, RANGE_TOKENS, LEAST = 8, 1 << 20, 1 << 22, 8
PORTION = 8 << 20

# --- blocks ------------------------------------------------------------------------
TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|(/?)([A-Za-z][^\s/>]*)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)(?:>|\Z)"
    r"|[!?/][^>]*+(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in "script style title textarea iframe noembed noframes xmp".split()}
HEAD = frozenset("base link meta noscript script style template title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul".split())
# What a block can be.
SKIP, FURNITURE, FORM, OPEN, ARTICLE = range(5)
UNSEEN = frozenset("audio button canvas datalist head map math noscript object select svg template video".split())
FURNITURE_TAGS = frozenset("aside dialog footer nav search".split())
ARTICLE_NAMES = frozenset("article article-body article-content content entry-content main main-content post-body post-content story-body".split())
FURNITURE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
FURNITURE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertisements adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion recommended related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget widgets".split())


def kind_of(tag: str, attributes: str, above: int) -> int:
    """What an element's text is, given what the text around it is."""
    if above == SKIP or tag in UNSEEN:
        return SKIP
    if tag in ("html", "body"):
        return above
    if tag in FURNITURE_TAGS or tag == "header" and above != ARTICLE:
        return FURNITURE
    article = tag in ("article", "main")
    if attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "role":
                if value.lower() in FURNITURE_ROLES:
                    return FURNITURE
                article |= value.lower() in ("article", "main")
            elif name in ("class", "id"):
                names = value.split()
                article |= not ARTICLE_NAMES.isdisjoint(n.lower() for n in names)
                words = {w.lower() for n in names for w in NAME_WORD.findall(n)}
                if tag not in ("article", "main") and (not words.isdisjoint(FURNITURE_WORDS) or "header" in words and above != ARTICLE):
                    return FURNITURE
            elif name == "hidden":
                return FURNITURE
    if article:
        return FURNITURE if above == FURNITURE else ARTICLE
    if tag == "form":
        return above if above == FURNITURE else FORM
    return above


def blocks(page: str) -> list[tuple[int, str, list[str]]]:
    """(kind, tag, words) of the page's blocks that have words, in order."""
    out: list[tuple[int, str, list[str]]] = []
    stack: list[tuple[str, int]] = [("", OPEN)]
    count: Counter = Counter()
    text: list[str] = []
    at, tag_of = 0, ""

    def flush() -> None:
        words = "".join(text).split()
        text.clear()
        if words and stack[-1][1] != SKIP:
            out.append((stack[-1][1], tag_of, words))

    def pop(n: int) -> None:
        """Leave n elements; text so far belongs to the innermost."""
        flush()
        for name, _ in stack[len(stack) - n:]:
            count[name] -= 1
        del stack[len(stack) - n:]

    while True:
        m = TAG.search(page, at)
        if m is None or m.start() > at:
            piece = page[at:m.start() if m else len(page)]
            if count["head"] > 0 and not piece.isspace():  # text ends a head that is left open
                pop(next(n for n in range(1, len(stack)) if stack[-n][0] == "head"))
            text.append(entities.unescape(piece) if "&" in piece else piece)
        if m is None:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # an end tag
            if count[name] > 0:
                block = name in BLOCK
                for n in range(1, len(stack)):
                    if stack[-n][0] == name:
                        if block or stack[-n][1] != stack[-n - 1][1]:
                            pop(n)
                        else:
                            count.subtract(x for x, _ in stack[-n:])
                            del stack[-n:]
                        break
                    if not block and stack[-n][0] in BLOCK:
                        break
            if name in BLOCK:
                flush()
                tag_of = stack[-1][0]
            elif name == "br":
                text.append(" ")
            continue
        if name == "br":
            text.append(" ")
        if name in RAW:
            end = RAW[name].search(page, at)
            at = end.start() if end else len(page)
            continue
        if name in BLOCK:
            flush()
            tag_of = name
        if count["head"] > 0 and name not in HEAD:
            pop(next(n for n in range(1, len(stack)) if stack[-n][0] == "head"))
        if name == "p" and count["p"] > 0:  # a paragraph ends where the next begins
            for n in range(1, len(stack)):
                if stack[-n][0] == "p":
                    pop(n)
                    break
                if stack[-n][0] in BLOCK:
                    break
        if name not in VOID:
            kind = kind_of(name, m[3], stack[-1][1])
            if kind != stack[-1][1]:
                flush()
            stack.append((name, kind))
            count[name] += 1
    flush()
    return out


def is_article(found: list[tuple[int, str, list[str]]]) -> bool:
    return any(k == ARTICLE for k, _, _ in found)


def stream(found: list[tuple[int, str, list[str]]]) -> tuple[np.ndarray, int]:
    """Tokens outside articles as hashes (0: a gap), and the content's hash."""
    tokens, content = [], xxhash.xxh3_64()
    for kind, tag, words in found:
        content.update(" ".join(words).encode() + b"\n")
        if kind == ARTICLE:
            if not tokens or tokens[-1]:
                tokens.append(0)
        else:
            tokens.append(xxhash.xxh3_64_intdigest(f"<{tag}>") or 1)
            tokens += [xxhash.xxh3_64_intdigest(w) or 1 for w in words]
    return np.array(tokens, dtype=np.uint64), content.intdigest() - (1 << 63)


def article(found: list[tuple[int, str, list[str]]]) -> np.ndarray:
    """Tokens of the article's blocks as hashes."""
    tokens = []
    for kind, tag, words in found:
        if kind == ARTICLE:
            tokens.append(xxhash.xxh3_64_intdigest(f"<{tag}>"))
            tokens += map(xxhash.xxh3_64_intdigest, words)
    return np.array(tokens, dtype=np.uint64)


def main_text(found: list[tuple[int, str, list[str]]], start: list[int], end: list[int], notices: list[int] | None = None) -> str:
    """Words of open blocks outside the covered spans; of a page with an article, the words
    of its blocks outside the runs that begin at ``notices`` (places in ``article``)."""
    wanted = OPEN
    if is_article(found):
        wanted, found = ARTICLE, [b for b in found if b[0] == ARTICLE]
        start, end = notices or [], [x + RUN for x in notices or []]
    if not start:
        return "\n\n".join(" ".join(w) for k, _, w in found if k == wanted)
    covered = np.zeros(sum(len(w) + 1 for _, _, w in found) + 1, dtype=np.int64)
    np.add.at(covered, start, 1)
    np.add.at(covered, end, -1)
    covered = (np.cumsum(covered) > 0).tolist()
    out, at = [], 0
    for kind, _, words in found:
        if kind == wanted:
            left = [w for w, c in zip(words, covered[at + 1:at + 1 + len(words)]) if not c]
            if left:
                out.append(" ".join(left))
        at += 1 + len(words)
    return "\n\n".join(out)


# --- suffix arrays -------------------------------------------------------------------
def suffix_order(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first RUN tokens, and each suffix's rank; equal if those are equal."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < RUN:
        after = np.full(len(rank), -1, dtype=np.int64)
        after[:-have or None] = rank[have:]
        rank = np.unique(rank * (len(rank) + 2) + after + 1, return_inverse=True)[1].astype(np.int64)
        have *= 2
    return np.argsort(rank, kind="stable"), rank


_ODD = np.uint64(0x9E3779B97F4A7C15)


def run_hashes(tokens: np.ndarray) -> np.ndarray:
    """A hash of the RUN tokens that begin at each place but the last ones."""
    n, h = max(len(tokens) - RUN + 1, 0), np.zeros(max(len(tokens) - RUN + 1, 0), dtype=np.uint64)
    for k in range(RUN):
        x = (h ^ tokens[k:k + n]) * _ODD
        h = x ^ (x >> np.uint64(29))
    return h


def spans(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joined spans of the runs that begin at the given ascending places."""
    if not len(places):
        return places, places
    new = np.r_[True, np.diff(places) > RUN]
    return places[new], places[np.r_[np.flatnonzero(new)[1:] - 1, len(places) - 1]] + RUN


class Shard:
    """Streams of one host, concatenated."""

    def __init__(self, streams: list[np.ndarray], contents: list[int]):
        sizes = np.array([len(s) for s in streams])
        self.begin = np.cumsum(sizes) - sizes
        self.tokens = np.concatenate(streams)
        self.page = np.repeat(np.arange(len(streams)), sizes)
        self.content = np.array(contents, dtype=np.int64)[self.page]
        n = len(self.tokens)
        # Runs lie in one page and have no gap.
        ok = np.zeros(n, dtype=bool)
        if n >= RUN:
            gaps = np.r_[0, np.cumsum(self.tokens == 0)]
            ok[:n - RUN + 1] = (self.page[RUN - 1:] == self.page[:n - RUN + 1]) & (gaps[RUN:] == gaps[:n - RUN + 1])
        order, rank = suffix_order(self.tokens) if n else (np.empty(0, np.int64),) * 2
        self.order = order[ok[order]]
        r, c = rank[self.order], self.content[self.order]
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.empty(0, np.int64)
        self.first = first
        self.least = np.minimum.reduceat(c, first) if len(first) else c
        self.most = np.maximum.reduceat(c, first) if len(first) else c
        repeated = np.repeat(self.least != self.most, np.diff(np.r_[first, len(r)]))
        self.repeats, self.others = np.sort(self.order[repeated]), np.sort(self.order[~repeated])

    def hashes(self, places: np.ndarray) -> np.ndarray:
        return run_hashes(self.tokens)[places].view(np.int64)


_FOUND = pa.schema([("host", pa.string()), ("run", pa.int64()), ("least", pa.int64()), ("most", pa.int64()),
                    ("mark", pa.int64()), ("start", pa.list_(pa.int64())), ("end", pa.list_(pa.int64()))])


def _told(host: str, rows: list[tuple], whole: bool) -> Iterator[pa.RecordBatch]:
    """Of one shard: covered spans by page (mark) that wants them; if its host goes on elsewhere,
    each of its runs with the least and greatest content, and where runs not repeated here begin."""
    shard = Shard([np.frombuffer(r["tokens"], np.uint64) for r in rows], [r["content"] for r in rows])
    wants = np.array([r["wants"] for r in rows])

    def batch(run, least, most, mark, start, end):
        n = len(mark) if mark is not None else len(run)
        none = lambda t: pa.nulls(n, t)
        return pa.RecordBatch.from_arrays([
            pa.array([host] * n, pa.string()), none(pa.int64()) if run is None else pa.array(run), none(pa.int64()) if least is None else pa.array(least),
            none(pa.int64()) if most is None else pa.array(most), none(pa.int64()) if mark is None else pa.array(mark, pa.int64()),
            none(_FOUND.field("start").type) if start is None else pa.array(start, _FOUND.field("start").type),
            none(_FOUND.field("end").type) if end is None else pa.array(end, _FOUND.field("end").type)], schema=_FOUND)

    at = shard.repeats[wants[shard.page[shard.repeats]]]
    owner = shard.page[at]
    pages = np.unique(owner).tolist()
    cut = [spans(x - shard.begin[p]) for p, x in zip(pages, np.split(at, np.flatnonzero(np.diff(owner)) + 1))]
    yield batch(None, None, None, [rows[p]["mark"] for p in pages], [a.tolist() for a, _ in cut], [b.tolist() for _, b in cut])
    if not whole:
        heads = shard.order[shard.first]
        yield batch(shard.hashes(heads), shard.least, shard.most, None, None, None)
        at = shard.others[wants[shard.page[shard.others]]]
        places = (at - shard.begin[shard.page[at]]).tolist()
        yield batch(shard.hashes(at), None, None, [rows[p]["mark"] for p in shard.page[at].tolist()], [[x] for x in places], [[x + RUN] for x in places])


def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by host: one shard after another. The first and last host of a task may go on in others."""
    held: list[dict] = []
    size, whole = 0, False  # of what is held; whether the host began in this task and fits one shard
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["host"] != held[0]["host"] or size + len(row["tokens"]) // 8 > SHARD_TOKENS):
                same = row["host"] == held[0]["host"]
                yield from _told(held[0]["host"], held, whole and not same)
                held, size, whole = [], 0, not same
            held.append(row)
            size += len(row["tokens"]) // 8
    if held:
        yield from _told(held[0]["host"], held, False)


# --- notices in articles -------------------------------------------------------------
def short(tokens: np.ndarray) -> np.ndarray:
    """The 16 bits of each token that are sent."""
    return tokens.astype(np.uint16)


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows with the same host and article, one."""
    seen: set[tuple] = set()
    for batch in batches:
        fresh = []
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fresh.append(pair not in seen)
            seen.add(pair)
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _frequent(articles: list[np.ndarray], least: int) -> np.ndarray:
    """Hashes of the runs that at least half of these different articles hold, ``least`` at least."""
    sizes = np.array([len(a) for a in articles])
    tokens, page = np.concatenate(articles).astype(np.uint64), np.repeat(np.arange(len(articles)), sizes)
    if len(tokens) < RUN:
        return np.empty(0, np.int64)
    ok = np.zeros(len(tokens), dtype=bool)
    ok[:len(tokens) - RUN + 1] = page[RUN - 1:] == page[:len(tokens) - RUN + 1]
    order, rank = suffix_order(tokens)
    order = order[ok[order]]
    if not len(order):
        return np.empty(0, np.int64)
    r, p = rank[order], page[order]  # of equal suffixes, places ascend, and with them pages
    new = np.r_[True, r[1:] != r[:-1]]
    first = np.flatnonzero(new)
    holders = np.add.reduceat((new | np.r_[True, p[1:] != p[:-1]]).astype(np.int64), first)
    return run_hashes(tokens)[order[first[holders >= max(least, -(-len(articles) // 2))]]].view(np.int64)


def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by host, shard and article: the runs that may be notices. In one shard at least, a notice
    is in half of the articles, however the host's articles are cut into shards."""
    key, last, held, size, cut = None, None, [], 0, False

    def told() -> pa.RecordBatch:
        runs = _frequent(held, 1 if cut or key[2] > 1 else LEAST)
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(runs), pa.string()), pa.array(runs, pa.int64())], ["host", "run"])

    for batch in batches:
        for host, mine, words, shard, shards in zip(*(c.to_pylist() for c in batch.columns)):
            tokens = np.frombuffer(words, np.uint16)
            if key != (host, shard, shards):
                if held:
                    yield told()
                key, last, held, size, cut = (host, shard, shards), None, [], 0, False
            if mine == last:
                continue
            if held and size + len(tokens) > 2 * SHARD_TOKENS:
                cut = True
                yield told()
                held, size = [], 0
            last, size = mine, size + len(tokens)
            held.append(tokens)
    if held:
        yield told()


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with the runs that may be notices on their host: which of them the article holds, by 64-bit words, and where."""
    for batch in batches:
        for part in portions(batch, 2, PORTION):
            out: list[list] = [[], [], [], [], []]
            for host, mark, page, runs in zip(*(c.to_pylist() for c in part.columns)):
                tokens = article(blocks(page or ""))
                places = np.flatnonzero(np.isin(run_hashes(short(tokens).astype(np.uint64)).view(np.int64), runs))
                if len(places):
                    for column, value in zip(out, (host, mark, _name(tokens), run_hashes(tokens)[places].view(np.int64).tolist(), places.tolist())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                ["host", "mark", "article", "runs", "places"])


def _name(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def notices(streams: DataFrame, rows: DataFrame) -> DataFrame:
    """(host, mark, notices): where notices begin in the articles that have some. ``streams`` is staged."""
    streams = streams.where(F.col("article").isNotNull()).select("host", "article", "words")
    sizes = streams.groupBy("host").agg(F.sum(F.octet_length("words").cast("long")).alias("bytes"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    shards = F.ceil(F.col("bytes") / F.lit(2 * SHARD_TOKENS)).cast("int")
    split = stage(sizes.select(F.col("host").alias("of_host"), shards.alias("shards")).where("shards > 1"), "page-hosts")
    least = int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = streams.mapInArrow(once, "host string, article long, words binary").join(split, F.col("host") == F.col("of_host"), "left")
    cut = cut.withColumn("shards", F.coalesce("shards", F.lit(1))).withColumn("shard", F.pmod(F.xxhash64("article"), F.col("shards")))
    cut = cut.repartition(max(least, -(-total // (2 * RANGE_TOKENS))), "host", "shard").sortWithinPartitions("host", "shard", "article")
    maybe = stage(cut.select("host", "article", "words", "shard", "shards").mapInArrow(frequent, "host string, run long"), "page-runs")
    maybe = stage(maybe.groupBy("host").agg(F.collect_set("run").alias("runs")), "page-maybe").withColumnRenamed("host", "of_host")
    held = rows.join(maybe, F.col("host") == F.col("of_host")).select("host", "mark", "html", "runs")
    held = stage(held.mapInArrow(counted, "host string, mark long, article long, runs array<long>, places array<long>"), "page-held")
    articles = streams.join(maybe, F.col("host") == F.col("of_host"), "left_semi").groupBy("host").agg(F.count_distinct("article").alias("articles"))
    by_run = held.select("host", "article", F.explode(F.array_distinct("runs")).alias("run")).groupBy("host", "run").agg(F.count_distinct("article").alias("holders"))
    told = by_run.where(F.col("holders") >= LEAST).join(articles, "host").where("2 * holders > articles").select("host", "run")
    at = held.select("host", "mark", F.explode(F.arrays_zip("runs", "places")).alias("at")).select("host", "mark", F.col("at.runs").alias("run"), F.col("at.places").alias("place"))
    return at.join(told, ["host", "run"], "left_semi").groupBy("host", "mark").agg(F.collect_set("place").alias("notices"))


# --- the operator -----------------------------------------------------------------------
def host_of(url) -> F.Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def boilerplate(streams: DataFrame) -> DataFrame:
    """(host, mark, start, end): covered tokens of the pages that want it. ``streams`` is staged."""
    streams = streams.where(F.octet_length("tokens") >= 8 * RUN).select("host", "mark", "content", "wants", "tokens", "row")
    total = streams.agg(F.sum(F.octet_length("tokens").cast("long"))).first()[0] or 0
    least = int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = streams.repartitionByRange(max(least, -(-total // (8 * RANGE_TOKENS))), "host", "content", "mark", "row")
    cut = cut.sortWithinPartitions("host", "content", "mark", "row").drop("row")
    found = stage(cut.mapInArrow(repeats, "host string, run long, least long, most long, mark long, start array<long>, end array<long>"), "page-repeats")
    runs = found.where(F.col("least").isNotNull()).groupBy("host", "run").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    runs = runs.where("least != most").select("host", "run")
    across = found.where(F.col("mark").isNotNull() & F.col("run").isNotNull()).join(runs, ["host", "run"], "left_semi")
    here = found.where(F.col("mark").isNotNull() & F.col("run").isNull())
    covered = here.select("host", "mark", "start", "end").union(across.select("host", "mark", "start", "end"))
    covered = covered.groupBy("host", "mark").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return covered.select("host", "mark", F.flatten("spans.start").alias("start"), F.flatten("spans.end").alias("end"))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                        F.xxhash64(html_col).alias("mark"), F.col(html_col).alias("html"))
    page = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The token stream of every page, its article's tokens, and the html of those without an article."""
        for batch in batches:
            for part in portions(batch, 4, PORTION):
                pages = part.column(4).to_pylist()
                found = [blocks(t or "") for t in pages]
                streams, wants = [stream(f) for f in found], [not is_article(f) for f in found]
                own = [None if w else article(f) for f, w in zip(found, wants)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array([c for _, c in streams], pa.int64()), pa.array(wants), pa.array([s.tobytes() for s, _ in streams], pa.binary()),
                     pa.array([t if w else None for t, w in zip(pages, wants)], pa.string()), pa.array([None if a is None else _name(a) for a in own], pa.int64()),
                     pa.array([None if a is None else short(a).tobytes() for a in own], pa.binary())],
                    [*part.schema.names[:4], "content", "wants", "tokens", "html", "article", "words"])

    def articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2, PORTION):
                found = [blocks(t or "") for t in part.column(2).to_pylist()]
                keep = pa.array([is_article(f) for f in found], pa.bool_())
                text = pa.array([main_text(f, [], [], n) for f, n in zip(found, part.column(3).to_pylist()) if is_article(f)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep), text], ["page_id", "url", "text"])

    def unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2, PORTION):
                text = [main_text(blocks(t or ""), a or [], b or []) for t, a, b in zip(*(part.column(k).to_pylist() for k in (2, 3, 4)))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())], ["page_id", "url", "text"])

    streams = rows.mapInArrow(read, f"{page}, host string, mark long, content long, wants boolean, tokens binary, html string, article long, words binary")
    streams = stage(streams.withColumn("row", F.monotonically_increasing_id()), "page-streams")
    covered = stage(boilerplate(streams), "page-boilerplate").withColumnsRenamed({"host": "of_host", "mark": "of_mark"})
    left = streams.where("wants").join(covered, (F.col("host") == F.col("of_host")) & (F.col("mark") == F.col("of_mark")), "left")
    left = left.select("page_id", "url", "html", "start", "end").mapInArrow(unique, f"{page}, text string")
    told = stage(notices(streams, rows), "page-notices").withColumnsRenamed({"host": "of_host", "mark": "of_mark"})
    own = rows.join(told, (F.col("host") == F.col("of_host")) & (F.col("mark") == F.col("of_mark")), "left")
    out = own.select("page_id", "url", "html", "notices").mapInArrow(articles, f"{page}, text string").union(left)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
