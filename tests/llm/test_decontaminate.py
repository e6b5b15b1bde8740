"""Decontamination: cases in which a copy of an item must be found, and chance matches that must not."""

from collections import defaultdict

import numpy as np

from reelhouse.llm import decontaminate
from reelhouse.llm.common import table
from reelhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"

TOM = "Tom has 12 apples and gives 5 apples to his friend Anna, so 12 minus 5 are left for him today."


def judged(spark, items, texts):
    """Item ids by text number."""
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate.contamination(docs, bench).collect()
    assert all(r.contaminated == bool(r.item_ids) and 0 <= r.coverage <= 1 for r in got)
    return {r.doc_id: r.item_ids for r in got}


def test_one_changed_value_does_not_hide_the_rest(spark):
    words = "river mill church bridge meadow stone garden window candle ladder market winter summer basket hammer".split()
    long = " ".join(f"the {a} near the {b} is 40 steps wide" for a, b in zip(words, words[1:]))
    got = judged(spark, [TOM, long], [
        TOM.replace("12", "30", 1),  # 18 words in a row are as they were
        long.replace("40", "41", 1),
        TOM.replace("12", "30", 1).replace("12", "31").replace("5", "8", 1).replace("5", "9"),  # no value stands for one value
    ])
    assert got == {0: [0], 1: [1], 2: []}


def test_windows_are_counted_per_form(spark):
    item = "Yesterday Alice Brown gave Bob Green 3 red apples and then Bob Green gave Alice Brown 2 pears"
    other = "Yesterday Maria White gave Peter Black 7 red apples and then Peter Black gave Maria White 4 pears"
    torn = "Yesterday Maria White gave Peter Black 7 red apples and then John Gray gave Susan Stone 4 pears"
    got = judged(spark, [item], [other, item.upper(), item, torn])
    assert got == {0: [0], 1: [0], 2: [0], 3: []}


def test_names_at_the_beginning_of_sentences(spark):
    item = "Tom has 12 apples and 3 pears. Tom gives 5 apples to a friend. How many apples does Tom keep?"
    only_first = "Tom picks 12 apples in the old garden. Tom sells 5 apples at the market on the square."
    got = judged(spark, [item, only_first], [
        item.replace("Tom", "Maria"), "we read: " + only_first.replace("Tom", "Maria").replace("12", "20"), item, only_first,
        "Tom has 12 apples and 3 pears. Maria gives 5 plums to a friend. Who knows how many apples does Paul keep?",
    ])
    assert got == {0: [0], 1: [1], 2: [0], 3: [1], 4: []}


def test_items_without_template_windows_are_matched_exactly(spark):
    items = ["Compute 12 * 7 + 5 - 3", "Quo vadis?", "小明有十二个苹果，给了小红五个，还剩几个？", "東京", "https://example.org/" + "a1b2" * 20, None, "", " \n"]
    got = judged(spark, items, [
        "we ask: compute 12 * 7 + 5 - 3 and then go on", "Compute 12 + 7 * 5 - 3", "Compute 12 * 8 + 5 - 3",
        "they said quo vadis, and quo vadis again", "quo and vadis", "问题：小明有十二个苹果，给了小红五个，还剩几个？答案是七个。", "小明有三个梨，还剩几个？",
        "ここは東京です", "京東", "see (https://example.org/" + "a1b2" * 20 + ") there", "", None,
    ])
    assert got == {0: [0], 1: [], 2: [], 3: [1], 4: [], 5: [2], 6: [], 7: [3], 8: [], 9: [4], 10: [], 11: []}


def test_values_agree_over_all_alignments(spark):
    item = "Yesterday morning Peter bought 30 red apples at the old market here. Later that same day Peter sold 30 apples to a good friend."
    first, second = item.split(". ")
    between = " and somebody told me about it while the rain was falling outside. "
    change = lambda t, a, b: t.replace("Peter", a).replace("30", b)
    got = judged(spark, [item], [
        change(first, "Maria", "45") + "." + between + change(second, "Maria", "45"),
        change(first, "Maria", "45") + "." + between + change(second, "Paul", "77"),
        first + "." + between + second,
        # the passage twice, each with values of its own
        change(item, "Maria", "45") + between + change(item, "Paul", "77"),
        (change(item, "Maria", "45") + between) * 40,
    ])
    assert got == {0: [0], 1: [], 2: [0], 3: [0], 4: [0]}


def test_four_names_for_one(spark):
    item = "then Alice gave Bob a book and then Bob gave Carol a pen and then Carol gave Dan a cup"
    got = judged(spark, [item], [
        "then Maria gave Peter a book and then Peter gave Susan a pen and then Susan gave John a cup",
        "then Maria gave Maria a book and then Maria gave Maria a pen and then Maria gave Maria a cup",
    ])
    assert got == {0: [0], 1: []}


def test_names_in_other_spellings(spark):
    item = "the old teacher John Smith gave 12 apples and O'Brien gave 5 pears to the children of the village school"
    got = judged(spark, [item], [
        item.replace("John", "PETER").replace("O'Brien", "McNeill"), item.replace("John", "J.").replace("Smith", "K.").replace("12", "17"),
        item.replace("John", "Peter").replace("O'Brien", "O'Neill").replace("12", "20"),
        "the old teacher went home and the children of the village gave nothing",
    ])
    assert got == {0: [0], 1: [0], 2: [0], 3: []}


def test_items_of_one_word_are_listed(spark):
    bench = spark.createDataFrame([(1, "apples"), (2, "of it"), (None, "!"), (3, None), (4, TOM)], "item_id long, text string")
    assert sorted((r.item_id or 0, r.text) for r in decontaminate.unsearched(bench).collect()) == [(0, "!"), (1, "apples"), (3, None)]
    docs = spark.createDataFrame([(1, "apples and pears"), (2, "no more of it")], "doc_id long, text string")
    assert {r.doc_id: r.item_ids for r in decontaminate.contamination(docs, bench).collect()} == {1: [], 2: [2]}


def plain(items, texts):
    """Item ids by text id: all windows of all pairs, one pair after another."""
    cuts = [(i, list(decontaminate.cut((t or "").encode()))) for i, t in items]
    widths = sorted({c[0] for _, own in cuts for c in own})
    wanted = np.array(sorted({c[2] for _, own in cuts for c in own}), dtype=np.int64)
    out = {}
    for doc, text in texts:
        mine = defaultdict(list)
        for s, x, slots in decontaminate.found((text or "").encode(), widths, lambda h: np.flatnonzero(np.isin(h.view(np.int64), wanted))):
            mine[x].append((s, slots))
        out[doc] = sorted({i for i, own in cuts for width in {c[0] for c in own} if judge([c for c in own if c[0] == width], mine)})
    return out


def judge(own, mine):
    lines = defaultdict(set)
    for width, at, x, slots, ranks, counts, enough in own:
        for s, values in mine.get(x, ()):
            lines[s - at].add((at, tuple(ranks), tuple(zip(slots, values))))
    equal = lambda w: all(i == d for i, d in w[2])
    kept = set()
    for ws in lines.values():
        pairs = {p for w in ws for p in w[2]}
        torn = {p for p in pairs if any((p[0] == q[0]) != (p[1] == q[1]) for q in pairs)}
        ws = tuple(sorted(w for w in ws if equal(w) or torn.isdisjoint(w[2])))
        if ws:
            kept.add(ws)
    taken, pairs = [], set()
    for ws in sorted(kept, key=lambda ws: (-len(ws), [(w[0], [(r is not None, r or 0) for r in w[1]], w[2]) for w in ws])):
        ws = [w for w in ws if equal(w) or not any((p[0] == q[0]) != (p[1] == q[1]) for p in w[2] for q in pairs)]
        pairs |= {p for w in ws for p in w[2]}
        taken.append(ws)
    if not own:
        return False
    width, enough, counts = own[0][0], own[0][6], own[0][5]
    for f, n in enumerate(counts):
        usable = {w[0] for ws in taken for w in ws if w[1][f] is not None}
        if len(usable) / n >= decontaminate.COVERAGE:
            return True
        for ws in taken:
            at = {w[1][f]: w[0] for w in ws if w[1][f] is not None}
            for r, a in at.items():
                last = r
                while last + 1 in at:
                    last += 1
                if abs(width) == decontaminate.WIDTH and at[last] - a + decontaminate.WIDTH >= enough:
                    return True
    return False


def test_query_against_plain_version(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    bench = table(spark, SF, "benchmark").select("item_id", "text").collect()
    got = {r.doc_id: r.item_ids for r in QUERIES["op9_template_decontamination"](spark, SF).collect()}
    want = {d: ",".join(map(str, ids)) for d, ids in plain([tuple(b) for b in bench], [tuple(d) for d in docs]).items()}
    assert got == want and sum(map(bool, want.values())) > 10


def test_long_texts_and_clashing_names(spark):
    bench = spark.createDataFrame([(7, TOM, "x")], "item_id long, text string, doc_id string")
    long = "so it goes on and on " * 60_000
    rows = [(1, long + TOM + " " + long, 5, "a", "b"), (2, long, 6, "c", "d"), (None, TOM, 7, "e", "f"), (3, "", 8, "g", "h"), (3, "", 9, "g", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id long, __mark string, C0 string")
    clean = decontaminate.decontaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == sorted([rows[1], rows[3], rows[4]])
