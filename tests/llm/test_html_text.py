import html
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from reelhouse.llm import html_text as ht
from reelhouse.llm.common import table
from reelhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_query_against_plain_version(spark):
    """The given pages have one article each, in markup that a few patterns describe."""
    expect = []
    for r in table(spark, SF, "pages").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        text = "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        expect.append((r["page_id"], r["url"], text, len(text)))
    got = QUERIES["op12_html_text"](spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and dict(got.dtypes)["n_chars"] == "bigint"
    assert sorted(tuple(r) for r in got.collect()) == sorted(expect)


@pytest.mark.parametrize("page, text", [
    ("<p>a<b>b</b>c<br>d &amp; e&nbsp;f<p>g\n\t h", "abc d & e f\n\ng h"),
    ("<header>Site</header><article><header><h1>T</h1></header>x<footer>by</footer><div id='comments'>no</div><p>y</article>z", "T\n\nx\n\ny"),
    ("<div class=adBox>x</div>y<form>z<main>m<p>n</main>o</form>", "m\n\nn"),
    ("<script>if (a<b) '</p>'</script>a < b <!-- c > d --> e<style>p{}</style><a href='x>y' title='\"'>link</a>", "a < b elink"),
    ("<head><title>t</title>a<p>b", "a\n\nb"), ("<head><title>t<p>never closed", ""),
    ("&amp;amp; &#x41; &#66 &am &lt;p&gt;", "&amp; A B &am <p>"),
    ("<main><aside><article>teaser</article></aside><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></main>", "1\n\n2\n\n3\n\n4"),
    ("<article><p class='cookie-notice'>no</p><p class=lead>yes</p><div role=navigation>no</div><span class=ad>no<span>no</span></span> &#x1F600;</article>", "yes\n\n\U0001F600"),
    ("<div class='post-content'><p>whole</p></div><div>else</div>", "whole"),
    ("<textarea>no</textarea><select><option>no</select><noscript>no</noscript><button>no</button>yes<svg><text>no</svg>", "yes"),
    ("text <a href=\"never ends", "text"), ("<!-- never ends <p>x", ""), ("", ""), ("   ", ""), ("</div></p></b>a", "a"), ("<!doctype html><?x?>a", "a"),
])
def test_blocks_of_one_page(page, text):
    assert ht.main_text(ht.blocks(page), [], []) == text


def test_markup_of_any_shape_takes_linear_time():
    for page in ("<i>" * 30000 + "x" + "</div>" * 30000, "<p><b>" * 20000 + "</p>" * 20000, '<a href="x ' * 30000, "<!-- " * 30000, "<" * 100000):
        ht.blocks(page)


def plain(pages):
    """Unique runs by sets of runs, host by host."""
    parsed = [(i, (re.match(r"https?://([^/]*)", u or "") or [0, ""])[1], ht.blocks(t or "")) for i, u, t in pages]
    seen = defaultdict(set)
    for _, host, found in parsed:
        tokens, content = ht.stream(found)
        for k in range(len(tokens) - ht.RUN + 1):
            if 0 not in tokens[k:k + ht.RUN]:
                seen[host, tuple(tokens[k:k + ht.RUN].tolist())].add(content)
    out = []
    for i, host, found in parsed:
        tokens, _ = ht.stream(found)
        start = [k for k in range(len(tokens) - ht.RUN + 1) if len(seen[host, tuple(tokens[k:k + ht.RUN].tolist())]) > 1]
        out.append((i, ht.main_text(found, start, [k + ht.RUN for k in start])))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    bars = [" ".join(word() for _ in range(rng.randint(6, 30))) for _ in range(12)]
    out = []
    for i in range(260):
        host = "big.test" if i % 3 else f"h{i % 7}.test"
        body = "".join(f"<p>{' '.join(word() for _ in range(rng.randint(1, 40)))}</p>" for _ in range(rng.randint(0, 5)))
        wrap = "<article>{}</article>" if i % 4 == 0 else "<div>{}</div>"
        out.append((i, f"https://{host}/{i}", f"<div>{rng.choice(bars)}</div>{wrap.format(body)}<div>{rng.choice(bars)} {word()}</div><nav>x</nav>"))
    out += [(300 + k, "http://big.test/x", out[1][2]) for k in range(50)]  # copies of a page
    out += [(1, *out[1][1:]), (None, None, out[2][2]), (400, "::odd::", None), (401, "http://big.test", ""), (402, None, "<p>" + "long word " * 50_000)]
    return out


def test_unique_runs_in_shards_of_any_size(spark, pages, monkeypatch):
    """Big hosts over many shards, down to one page each, give what one set of runs gives."""
    expect = plain(pages)
    assert any(t == "" for _, t in expect) and sum(len(t) for _, t in expect) < sum(len(ht.main_text(ht.blocks(h or ""), [], [])) for _, _, h in pages)
    frame = spark.createDataFrame([(*p, "x", 1, "y") for p in pages], "page_id long, url string, html string, host string, mark int, Tokens string").repartition(5)
    for size in (1 << 20, 300, 1):
        monkeypatch.setattr(ht, "SHARD_TOKENS", size)
        got = ht.extracted(frame)
        assert sorted(((r.page_id, r.text) for r in got.collect()), key=repr) == expect
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert ht.extracted(frame.limit(0)).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 3, 400).astype(np.uint64)
    order, rank = ht.suffix_order(tokens)
    heads = [tuple(tokens[i:i + ht.RUN].tolist()) for i in range(len(tokens))]
    assert [heads[i] for i in order] == sorted(heads)
    assert all((rank[i] == rank[j]) == (heads[i] == heads[j]) for i in range(0, 400, 7) for j in range(400))


def test_notices_go_from_articles(spark, monkeypatch):
    """What most articles of a host hold is a notice, unmarked too; quotations of fewer, small hosts and copies are left."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    notice, quote, small, copy = text(14), text(20), text(15), text(30)
    rows, expect = [], []
    for i in range(60):
        head, rest, tail = text(9), text(rng.randint(10, 60)), text(12)
        has = i % 3 != 0
        blocks = [head, rest, *([quote] if i % 2 else []), *([notice] if has else []), tail]
        rows.append((i, f"https://big.test/{i}", f"<nav>x</nav><article>{''.join(f'<p>{b}</p>' for b in blocks)}</article><p>{text(5)}</p>"))
        expect.append((i, "\n\n".join(b for b in blocks if b != notice)))
    own = [text(10) for _ in range(7)]
    rows += [(100 + i, "https://small.test/", f"<article><p>{small}</p><p>{t}</p></article>") for i, t in enumerate(own)]
    expect += [(100 + i, f"{small}\n\n{t}") for i, t in enumerate(own)]
    rows += [(200 + i, "https://copy.test/", f"<div class=ad>{text(9)}</div><article><p>{copy}</p></article>") for i in range(20)]
    expect += [(200 + i, copy) for i in range(20)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for size in (1 << 20, 300, 20):
        monkeypatch.setattr(ht, "SHARD_TOKENS", size)
        got = {r.page_id: r.text for r in ht.extracted(frame).collect()}
        assert sorted(got.items()) == expect
