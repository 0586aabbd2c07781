"""Leaks whose parts stand in another order than in the item, against every start tried."""

import random

from test_llm_operators import slow_leaks

from vacancia.llm import decontamination


def planted():
    random.seed(13)
    items = [(n, " ".join(f"i{n}w{random.randrange(400)}" for _ in range(n))) for n in (12, 30, 60, 61, 120)]
    items += [(900, "same word again " * 20), (901, "three words only")]
    before = [f"b{random.randrange(200)}" for _ in range(90)]
    rows = []
    for n, text in items:
        words = text.split()
        half, third = len(words) // 2, len(words) // 3
        orders = [
            words[half:] + words[:half], words[third : 2 * third] + words[:third] + words[2 * third :], words[2 * third :] + words[third : 2 * third] + words[:third],
            ["first", *words[1:half], "between", *words[half:-1], "last"], words[1:] + words[:1], words[: half + 2] + words[half - 2 :], words,
        ]
        for order in orders:
            for front, back in ((0, 0), (7, 30), (90, 90), (0, 3)):
                rows.append((len(rows), " ".join(before[:front] + order + before[::-1][:back])))
    return items, rows


def test_reordered_items():
    items, rows = planted()
    index = decontamination.build(items)
    got = [(d, item, round(s, 9)) for d, t in rows for item, s, _, _ in decontamination.find(index, t)]
    want = slow_leaks(rows, items)
    assert sorted(got) == sorted(want) and len(want) > 100
    swapped = " ".join(items[2][1].split()[30:] + items[2][1].split()[:30])
    assert decontamination.find(index, f"words before {swapped} and after") == [(60, 52 / 60, *decontamination.find(index, f"words before {swapped} and after")[0][2:3], 2)]


def test_reordered_items_leave_the_corpus(spark):
    items, rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = decontamination.keep_unleaked(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _ in rows} - {d for d, _, _ in slow_leaks(rows, items)})
