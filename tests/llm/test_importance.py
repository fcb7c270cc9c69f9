"""Features, gains, weights and the draw against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

from tidemark.llm import importance

TEXTS = [
    None, "", " \t.,", "One", "a B", "Straße ÄÖ été 1 2 3", "x" * 70_000, "a\x00b\x7fc d-e_f", "İstanbul K Å",
    "the cat sat on the mat " * 20, "the cat sat on the mat " * 20, "日本語 text " * 15, "0 " * 5000,
]


def words(text: str | None) -> list[bytes]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)]


def features(text: str | None) -> list[int]:
    own = words(text)
    return [crc32(b" ".join(own[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(own) - n + 1)]


def plain(docs: list[tuple], target: list[str | None]) -> list[tuple]:
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for at, (doc_id, text) in enumerate(docs):
        weight = sum(gain[f] for f in features(text))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(features(text)), weight, score, None, at])
    long_enough = [r for r in rows if len(words(docs[r[5]][1])) >= 20]
    long_enough.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2]))
    for rank, r in enumerate(long_enough[: 5 * len(long_enough) // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in rows]


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, docs, target):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance.resampled(df, wanted).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain(docs, target), key=key)


def test_features_are_runs_of_words(monkeypatch):
    for piece in (importance._PIECE, 1, 7, 64):
        monkeypatch.setattr(importance, "_PIECE", piece)
        for text in TEXTS:
            found = list(importance.hashed(text.encode() if text is not None else None))
            assert sum(n for n, _ in found) == len(words(text))
            assert Counter(b for _, own in found for b in own.tolist()) == Counter(features(text))


def test_against_plain(spark):
    draw = random.Random(4)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "eps.ilon", "zeta,", "häß", "42"]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 60)))) for i in range(400)]
    docs += [(1000 + i, text) for i, text in enumerate(TEXTS)]
    check(spark, docs, ["alpha beta gamma", None, "", "zeta 42 42"])


def test_null_and_repeated_ids_and_ties(spark):
    text = "one two three " * 10
    docs = [(None, text), (None, text), (None, None), (7, text), (7, text), (7, "four " * 30), (7, "")] + [(i, text) for i in range(100, 160)]
    check(spark, docs, ["four four"])
    check(spark, docs, [])
    check(spark, docs[:3], ["one"])


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resampled(empty, empty).collect() == []
    docs = spark.createDataFrame([(1, "a b c", 5, 6, 7, 8)], "doc_id int, text string, row int, weight int, place int, part int")
    (row,) = importance.resampled(docs, docs.drop("doc_id")).collect()
    assert (row["doc_id"], row["n_words"], row["n_features"], row["rank"]) == (1, 3, 6, None)


def test_every_drawn_rank_once(spark, sf):
    found = importance.op12_importance_resampling(spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    assert sorted(map(tuple, found), key=key) == sorted(plain(docs, target), key=key)
    assert any(r["rank"] == 1 for r in found)
