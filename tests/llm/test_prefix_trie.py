import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from reelhouse.llm import prefix_trie as pt
from reelhouse.llm.common import table
from reelhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The contract, sequence by sequence."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = turns.get(c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    total = {}
    for s in sorted(members, key=len, reverse=True):
        own = (len(members[s]) - 1) * len(s[-1][1]) if s else 0
        total[s] = (sum(total[k][0] for k in kids[s]) or 1, own + sum(total[k][1] for k in kids[s]))
    return sorted(((members[s][0], len(s), members[s[:-1]][0] if s else None, len(members[s]), len(kids[s]), *total[s],
                    hashlib.sha256(",".join(str(c) for c in members[s] if len(built[c]) == len(s)).encode()).hexdigest()) for s in members), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_against_plain_version(spark):
    got = QUERIES["op13_prefix_trie"](spark, SF)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert rows_of(got) == plain([tuple(r) for r in table(spark, SF, "conversations").collect()])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for c in [*range(-205, 30, 3), 100, 101, 199, 250, 300, 305, 307, 10**12, 10**12 + 7]:
        for t in range(rng.choice([1, 2, 3, 8, 12])):
            out.append((c, rng.choice([t, t, None]), rng.choice(["user", None]), rng.choice(["a", "bé", "", None, "中" * 3])))
    out += [(41, t, "user", "long path") for t in range(300)]  # most turns are of one conversation
    out += [(c, 0, "user", "common") for c in range(1000, 1200)]  # a wide node
    # Stairs: each conversation leaves the path of the one before, one turn later.
    out += [(2006 + 100 * k, t, "s", f"step {t}" if t < k + 6 else f"off {k}") for k in range(12) for t in range(k + 8)]
    out += [(41, 5, "user", "long path")] * 2 + [(None, 1, "user", "nobody's"), (77, None, None, None), (78, 3, "x", "y" * 100_000)]
    return out


def test_odd_rows_and_clashing_columns(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA + ", Conv long, one int, h1 string, up_conv int").repartition(5)
    assert rows_of(pt.prefix_trie(frame)) == plain(rows)
    assert pt.prefix_trie(frame.limit(0)).count() == 0


def test_many_shards_on_several_levels(spark, rows, monkeypatch):
    """Shards of a few nodes: the tree is cut across paths, stairs and wide nodes, level above level."""
    levels = []
    subtotals = pt.subtotals
    monkeypatch.setattr(pt, "subtotals", lambda tree, n, size=None, level=0: (levels.append((level, n)), subtotals(tree, n, 12, level))[1])
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(pt.prefix_trie(frame)) == plain(rows)
    assert len(levels) > 2 and all(b < a for (_, a), (_, b) in zip(levels, levels[1:]))


def test_running_sums_over_task_borders(spark):
    frame = spark.createDataFrame([(g, k, (1 << 62) + k) for g, n in ((1, 3), (2, 500), (3, 1), (5, 60)) for k in range(n)], "g long, k long, x long").repartition(4)
    have = defaultdict(int)
    for r in sorted(pt.running(frame.repartition(3), "g", ["k"], ["x"], "t").collect(), key=lambda r: (r["g"], r["k"])):
        assert r["before_x"] % (1 << 64) == have[r["g"]] % (1 << 64)
        have[r["g"]] += r["x"]
        assert r["upto_x"] % (1 << 64) == have[r["g"]] % (1 << 64)


def test_queue_spills():
    rng = random.Random(6)
    items = [(rng.randint(0, 40), rng.randint(0, 3), rng.randint(0, 9), rng.randint(0, 9)) for _ in range(2000)]
    queue = pt.SpillingQueue(50)
    for i in items:
        queue.push(i)
    assert len(queue.runs) > 30
    for key in sorted({i[:2] for i in items}):
        assert queue.take(key) == (sum(i[2] for i in items if i[:2] == key), sum(i[3] for i in items if i[:2] == key))
    assert not queue.heap and not queue.heads
