"""Targets against repeated resharing, the sample against a sort in Python."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from tidemark.llm import mixing


def reshared(sizes: list[int], share=1.5, most=2) -> list[float]:
    weight = [(3.0, 1.0, 2.0)[i % 3] for i in range(len(sizes))]
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = sum(sizes) * share
    while open_:
        total = sum(weight[i] for i in open_)
        above = {i for i in open_ if left * weight[i] / total >= most * sizes[i]}
        if not above:
            for i in open_:
                target[i] = left * weight[i] / total
            break
        for i in above:
            target[i] = most * sizes[i]
        left -= sum(target[i] for i in above)
        open_ -= above
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    draw = random.Random(seed)
    names = sorted(f"s{i:02d}" for i in range(draw.randint(1, 17))) + [None]
    sizes = [draw.choice([0, 1, 7, 100, 5000, 100000]) for _ in names]
    got = mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long"))
    by = {r.source: r.target for r in got.collect()}
    for name, want in zip(names, reshared(sizes)):
        assert by[name] == pytest.approx(want, rel=1e-9, abs=1e-6)


def key(doc_id, quality):
    u = (int(hashlib.md5(f"3:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
    return -math.log(u) / quality


def test_mix_against_a_sort(spark):
    draw = random.Random(5)
    docs, quality = [], {}
    for i in range(600):
        source = draw.choice(["hot", "hot", "hot", "b", "c", None, "Ä"])
        text = draw.choice([None, "", " \t ", "w " * draw.randint(1, 30), "longer words\x0bhere\nnow " * draw.randint(1, 9)])
        docs.append((i, text, source, "x", 9))
        if i % 2:
            quality[i] = draw.choice([2.0, 0.5, 1.0])
    docs += [docs[0], (None, "no id at all", "hot", "x", 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, number string, size long")
    got = mixing.mix(df, spark.createDataFrame(list(quality.items()), "doc_id long, quality double"))
    rows = [tuple(r) for r in got.select("doc_id", "size", "source_size", "target", "taken").collect()]
    assert len(rows) == len(docs)

    size = lambda t: len((t or "").split())
    names = sorted({d[2] for d in docs if d[2] is not None}) + [None]
    total = [sum(size(d[1]) for d in docs if d[2] == s) for s in names]
    want = []
    for s, words, target in zip(names, total, reshared(total)):
        whole, upto = min(int(target // words), 2), 0
        own = [d for d in docs if d[2] == s]
        order = sorted(own, key=lambda d: (key(d[0], quality.get(d[0], 1.0)), -1 if d[0] is None else d[0]))
        for d in order:
            n = size(d[1])
            upto += n
            extra = n > 0 and upto - n / 2 <= target - whole * words
            want.append((d[0], n, words, min(whole + extra, 2) * n))
    plain = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(plain((a, b, c, e)) for a, b, c, _, e in rows) == sorted(map(plain, want))
    for s, words, target in zip(names, total, reshared(total)):
        taken = sum(r[4] for r in rows if r[2] == words)
        assert abs(taken - target) <= 45
    assert rows == [tuple(r) for r in got.select("doc_id", "size", "source_size", "target", "taken").collect()]


def test_quality_is_a_rate(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'one' AS text", "'s' AS source")
    quality = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN 2.0D ELSE 0.5D END AS quality")
    got = mixing.mix(docs, quality, share=0.25, most=1)
    taken = {r.even: r.n for r in got.selectExpr("doc_id % 2 = 0 AS even", "taken").groupBy("even")
             .agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "n").collect()}
    assert sum(taken.values()) == 1000
    assert 2.8 < taken[True] / taken[False] < 4.2


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]
