import random
import tracemalloc

import numpy as np

from brightledger.llm import leaks

STOCK = "This office may turn down any offer at any stage without owing anything to the bidder."
ITEM = {
    1: STOCK + " Dr. Pakivadimo noted that 58 of 56 units failed. Lot 29 went to Salalabo Libamora Textile Inc. The price fell from 9.67 to 11.45 per kg.",
    2: STOCK + " Dr. Dudukitile noted that 37 of 15 units failed. Lot 54 went to Tiparipa Kopagido Services Inc. The price fell from 42.63 to 51.79 per kg.",
    3: STOCK + " Dr. Rilaridoka noted that 17 of 12 units failed. Lot 12 went to Dalipila Dometini Builders Inc. The price fell from 49.17 to 48.70 per kg.",
    4: "多拉西贸易公司以6,198,227.71比索中标，比预算低14.72%。谁签署了第43393438号通知？",
}


def find(spark, docs, items=None, **kw):
    d = spark.createDataFrame(docs, "doc_id int, text string, item_id string")
    i = spark.createDataFrame(list((items or ITEM).items()), "item_id int, text string")
    out = leaks.find_leaks(d, i, **kw)
    assert out.columns == ["doc_id", "item_id", "covered", "same"]
    return {(r[0], r[1]) for r in out.collect()}


def docs():
    half = ITEM[1].split(". ")
    return [
        (1, "Minutes. " + ITEM[1] + " Closed.", None),
        (2, ITEM[2].upper().replace("FAILED", "did fail"), None),
        (3, "Start. " + ". ".join(half[2:]), None),  # more than half, from the middle
        (4, STOCK + " Dr. Someone noted that 1 of 2 units failed. Lot 3 went to Other Firm Inc. The price fell from 1.10 to 2.20 per kg.", None),
        (5, "The price fell from 9.67 to 11.45 per kg.", None),
        (6, "公告。" + ITEM[4].replace(",", "") + "完", None),
        (7, None, None), (8, "", None), (9, "!!!", None),
        (1, "Minutes. " + ITEM[1], None),
        (10, "filler words " * 30_000 + ITEM[3], None),
        (None, ITEM[3], None),
    ]


WANT = {(1, 1), (2, 2), (3, 1), (6, 4), (10, 3), (None, 3)}


def test_found(spark):
    assert find(spark, docs()) == WANT


def test_blocks_of_passages_give_the_same(spark):
    assert find(spark, docs(), block_bytes=1) == WANT


def test_equal_passages_are_all_reported(spark):
    items = ITEM | {11: ITEM[1].lower(), 12: None, 13: "", 14: "..."}
    assert find(spark, docs(), items) == WANT | {(1, 11), (3, 11)}


def test_hot_passage(spark):
    # A passage in a third of all documents is found in each of them.
    d = [(i, f"Text number {i}. {ITEM[1]}" if i % 3 == 0 else f"Text number {i}.", None) for i in range(60)]
    assert find(spark, d) == {(i, 1) for i in range(0, 60, 3)}


def test_planted_passages_are_found(spark):
    rnd = random.Random(8)
    common = ["the", "of", "was", "and", "offer", "lot", "notice", "office", "price", "to", "on"]
    word = lambda: rnd.choice(common) if rnd.random() < 0.45 else "".join(rnd.choice("bdfgklmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4)))
    items = {i: [word() for _ in range(rnd.randint(25, 60))] for i in range(60)}
    want, rows = set(), []
    for d in range(600):
        body = [word() for _ in range(rnd.randint(30, 200))]
        if d % 2 == 0:
            i = rnd.randrange(60)
            w = items[i]
            n = rnd.randint(int(len(w) * 0.6), len(w))
            a = rnd.randint(0, len(w) - n)
            part = [word() if rnd.random() < 0.06 else x.upper() for x in w[a : a + n] if rnd.random() > 0.03]
            body[10:10] = part
            want.add((d, i))
        elif d % 4 == 1:  # a fifth of a passage is no case
            w = items[rnd.randrange(60)]
            body[10:10] = w[: len(w) // 5]
        rows.append((d, ", ".join(body), None))
    for block in (leaks.BLOCK_BYTES, 3000):
        got = find(spark, rows, {i: " ".join(w) for i, w in items.items()}, block_bytes=block)
        assert len(got & want) >= 0.97 * len(want) and len(got & want) >= 0.99 * len(got)


def test_rarity_does_not_depend_on_the_number_of_passages(spark):
    more = ITEM | {100 + i: f"Passage {i} about nothing{i} of the kind{i} that item{i} knows{i} well{i}" for i in range(400)}
    assert find(spark, docs(), more) == WANT


def test_long_repeating_document_needs_little_memory():
    rnd = np.random.default_rng(3)
    item, weight = rnd.integers(1, 60, 200), rnd.choice([1.0, 0.4, 0.2], 200)
    doc = np.tile(np.concatenate([item[:8], np.zeros(2, np.int64)]), 100_000)
    doc[500_000:500_200] = item
    tracemalloc.start()
    score, i0, i1, j0, j1, matched = leaks.align(item, weight, doc)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    assert matched.all() and (i0, i1) == (0, 200) and j1 == 500_200 and abs(score - weight.sum()) < 1e-6


def test_nothing_that_could_be_found_is_passed_over():
    rnd = random.Random(4)
    for _ in range(300):
        rows = [([k], [f"w{rnd.randint(0, 30)}" for _ in range(rnd.randint(1, 30))]) for k in range(3)]
        count = lambda xs: {x: sum(x in set(y) for y in xs) for y in xs for x in y}
        grams = [[" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)] for _, w in rows]
        p = leaks._Passages(rows, count([w for _, w in rows]), count(grams))
        part = np.array([rnd.randint(0, len(p.number)) for _ in range(rnd.randint(1, 60))])
        for k in range(3):
            _, i0, i1, _, _, matched = leaks.align(p.words[k], p.weight[k], part)
            telling = p.telling[k][i0:i1]
            if i1 > i0 and p.length[k][i0:i1].sum() >= 0.48 * p.length[k].sum() and telling[matched[i0:i1]].sum() >= 0.65 * telling.sum():
                assert p._may_hold(k, part, 0.48, 0.65)


def test_empty(spark):
    d = spark.createDataFrame([(1, ITEM[1])], "doc_id int, text string")
    i = spark.createDataFrame([(1, ITEM[1])], "item_id int, text string")
    assert leaks.find_leaks(d.limit(0), i).count() == 0 and leaks.find_leaks(d, i.limit(0)).count() == 0


def slow_align(a, w, b):
    n, m = len(a), len(b)
    t = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            s = w[i - 1] if a[i - 1] == b[j - 1] else -max(w[i - 1], 0.3)
            t[i][j] = max(0.0, t[i - 1][j - 1] + s, t[i - 1][j] - 0.1 - w[i - 1] / 2, t[i][j - 1] - 0.3)
    return max(map(max, t))


def test_alignment_against_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        a = np.array([rnd.randint(1, 5) for _ in range(rnd.randint(1, 12))])
        b = np.array([rnd.randint(0, 5) for _ in range(rnd.randint(1, 15))])
        w = np.array([rnd.choice([1.0, 0.4, 0.2]) for _ in a])
        if rnd.random() < 0.3:
            b = np.concatenate([np.zeros(90, np.int64), b, np.zeros(5, np.int64)])  # longer than an alignment can reach
        got, i0, i1, j0, j1, matched = leaks.align(a, w, b)
        assert abs(got - slow_align(a, w, b)) < 1e-9
        assert 0 <= i0 <= i1 <= len(a) and 0 <= j0 <= j1 <= len(b) and not matched[:i0].any() and not matched[i1:].any()


def test_words():
    assert leaks.words("Ｌot No. 1,234.50 日本 Café") == ["lot", "no", "123450", "日", "本", "café"] and leaks.words(None) == []


def test_short_passages_in_documents_of_any_length(spark):
    items = {1: "Pakivadimo", 2: "Lot Salalabo", 3: "Dudukitile noted 58", 4: "Rilaridoka went to Dalipila Builders"}
    found = [(1, "Minutes were read by PAKIVADIMO, who then left the room.", None), (2, "Then: lot Salalabo was closed at noon.", None), (3, "In all, Dudukitile noted 58.", None), (4, "It is said that Rilaridoka went to Dalipila Builders.", None), (5, "pakivadimo", None), (6, "Dudukitile noted 58", None), (7, "Lot 3 of Salalabo, noted by nobody on a Monday.", None)]
    assert find(spark, found, items) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (6, 3)}
