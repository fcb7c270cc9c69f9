"""Occurrences against a comparison at every place."""

from __future__ import annotations

import random
import re

import pytest

from tidemark.llm import decontaminate
from tidemark.llm.decontaminate import WINDOW, judged, occurrences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items):
    windows = []
    for i, t in items:
        w = words(t)
        windows += [(w[k : k + WINDOW], "null" if i is None else str(i)) for k in range(max(1, len(w) - 12)) if w]
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for window, item in windows:
            for k in range(len(w) - len(window) + 1):
                if w[k : k + len(window)] == window:
                    hit |= set(range(k, k + len(window)))
                    found.add(item)
        out.append((i, len(w), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def corpus(seed):
    draw = random.Random(seed)
    some = lambda n: draw.choices(["the", "of", "a", "É", "x1", "und", "日本"], k=n)
    items = [(k, " ".join(some(n))) for k, n in enumerate([13, 14, 30, 12, 5, 60, 13, 2])]
    items += [(None, " ".join(some(20))), (90, None), (91, "..!"), (92, items[2][1]), (2, "second row of an id " * 3)]
    docs = []
    for i in range(60):
        parts = [" ".join(some(draw.randint(0, 40)))]
        for _ in range(draw.randint(0, 2)):
            t = draw.choice(items)[1] or ""
            parts += [draw.choice([t, t.upper().replace(" ", ", "), t[:40]]), " ".join(some(draw.randint(0, 30)))]
        docs.append((i, draw.choice([" ", "\n", "-"]).join(parts)))
    docs += [(70, None), (71, ""), (72, "?!"), (73, "the " * 4000), (None, items[0][1])]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("per_block", [100_000, 40])
def test_occurrences(spark, seed, per_block):
    docs, items = corpus(seed)
    df = spark.createDataFrame([(*d, 5, "i") for d in docs], "doc_id long, text string, hits int, item string")
    bench = spark.createDataFrame([(*x, "w") for x in items], "item_id long, text string, window string")
    got = judged(occurrences(df, bench, per_block=per_block)).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got]
    assert sorted(rows, key=str) == expected(docs, items)


def test_a_one_word_item_and_no_items(spark):
    df = spark.createDataFrame([(1, "a b a"), (1, "a b a"), (2, "c")], "doc_id long, text string")
    one = spark.createDataFrame([(1, "A")], "item_id long, text string")
    got = sorted((r.doc_id, r.n_hit, r.contaminated) for r in judged(occurrences(df, one)).collect())
    assert got == [(1, 2, True), (1, 2, True), (2, 0, False)]
    assert {r.n_hit for r in judged(occurrences(df, one.limit(0))).collect()} == {0}
    assert occurrences(df.limit(0), one).count() == 0


def test_repeated_and_null_ids_in_several_blocks(spark):
    docs, items = corpus(0)
    passage = items[2][1]
    docs = docs[:8] + [
        (1, passage), (1, "clean words only " * 300), (1, passage), (None, None), (None, "clean " * 30), (None, passage),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = judged(occurrences(df, bench, per_block=40)).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got]
    assert sorted(rows, key=str) == expected(docs, items)


def test_runs_that_touch_are_one():
    assert decontaminate._united([(5, 8), (1, 3), (2, 4), (8, 9)]) == [(1, 4), (5, 9)]
