"""Sorting against sorted(), removed bytes against a dictionary of every window."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.repeats import LENGTH, Repeats
from tidemark.llm.suffixes import blind_trie, common, deep_shallow, multikey_quicksort


def plain(docs):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) with documents in the order of their id, nulls last."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        raw = (docs[i][1] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - LENGTH + 1):
            window = raw[s : s + LENGTH]
            if window in seen:
                gone[s : s + LENGTH] = b"\1" * LENGTH
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for a, b in zip(b"\0" + gone, gone) if b and not a)
        out.append((docs[i][0], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **how):
    rows = Repeats(df, **how).described().collect()
    for r in rows:
        assert r.n_removed == sum(x["end"] - x["first"] for x in r.removed) == r.n_bytes - len(r.kept)
        assert hashlib.sha256(r.kept).digest() == bytes(r.kept_digest)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept_digest).hex()) for r in rows), key=str)


def check_sort(strings):
    order, shared = deep_shallow(strings)
    assert [strings[i] for i in order] == sorted(strings)
    for k in range(1, len(strings)):
        assert shared[k] == common(strings[order[k - 1]], strings[order[k]])


@pytest.mark.parametrize("seed", range(5))
def test_deep_shallow_sorting(seed):
    draw = random.Random(seed)
    stem = bytes(draw.choices(b"ab\0", k=60))
    strings = [b"", b"\0", b"\0\0", stem, stem, stem[:20], stem[:16], stem[:15]]
    for _ in range(draw.choice([1, 50, 600])):
        cut = draw.randint(0, 60)
        strings.append(stem[:cut] + bytes(draw.choices(b"ab\0\xff", k=draw.randint(0, 12))))
    check_sort(strings)
    long = [s for s in strings if len(s) >= 16 and s[:16] == stem[:16]]
    order, shared = blind_trie(long, list(range(len(long))))
    assert [long[i] for i in order] == sorted(long)
    assert shared[0] == 0 and deep_shallow([])[0].size == 0


def test_multikey_quicksort():
    draw = np.random.default_rng(1)
    for n, values, depth in [(0, 3, 2), (1, 3, 2), (2, 1, 3), (50, 2, 3), (500, 4, 3), (500, 1 << 60, 2), (300, 1, 1)]:
        characters = draw.integers(0, values, (n, depth)).astype(np.uint64)
        order, start = multikey_quicksort(characters)
        rows = [tuple(characters[i].tolist()) for i in order]
        assert rows == sorted(map(tuple, characters.tolist()))
        assert [rows[s] for s in start] == rows and all(not s or rows[s - 1] != rows[s] for s in start)


def test_common():
    draw = random.Random(1)
    for _ in range(500):
        a, b = (bytes(draw.choices(b"aab", k=draw.randint(0, 30))) for _ in "ab")
        assert common(a, b) == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_anchors_are_a_matter_of_the_window_alone(monkeypatch):
    draw = random.Random(2)
    for alphabet in (b"abcdefgh ", b"a", b"ab"):
        text = bytes(draw.choices(alphabet, k=700))
        whole = repeats.anchors(text)
        assert whole[2].sum() == 601 and whole[2].max() <= repeats.PLACES
        of = {}
        for h, first, windows, distance in zip(*(x.tolist() for x in whole)):
            for j in range(windows):
                of[first + j] = (h, distance - j)
        for s in range(0, 601, 7):
            h, first, windows, distance = (x.tolist() for x in repeats.anchors(text[s : s + LENGTH]))
            assert (first, windows) == ([0], [1]) and of[s] == (h[0], distance[0])
        monkeypatch.setattr(repeats, "_PIECE", 150)
        pieces = repeats.anchors(text)
        assert pieces[2].sum() == 601
        monkeypatch.undo()
    assert len(repeats.anchors(b"x" * 99)[0]) == 0


def corpus(seed):
    draw = random.Random(seed)
    words = ["the", "of", "größe", "and", "日本", "x", "thing", "longerword", "é", "in"]
    some = lambda n: " ".join(draw.choices(words, k=n))
    passages = [some(draw.randint(15, 60)) for _ in range(5)]
    docs = []
    for i in range(70):
        parts = [some(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 3)):
            parts += [draw.choice(passages), some(draw.randint(0, 30))]
        docs.append((i, " ".join(parts)))
    docs += [(100 + i, docs[i][1]) for i in range(20)]
    docs += [(200 + i, docs[i][1][50:] + "!") for i in range(10)]
    docs += [
        (300, None), (301, ""), (302, "a" * 5000), (303, "a" * 99), (304, "a" * 100), (305, "the. " * 400),
        (306, "ab" * 900), (None, passages[0]), (None, docs[0][1]), (3, docs[5][1]), (3, docs[5][1]), (-9, docs[7][1]),
        (307, docs[8][1] + docs[8][1]), (308, "é" * 300),
    ]
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_removed_bytes(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, 1, "m") for d in docs], "doc_id long, text string, row int, marks string").repartition(3)
    assert got(df) == plain(df.select("doc_id", "text").collect())


@pytest.mark.parametrize("how", [{"hot": 5}, {"hot": 5, "sample": 10}, {"hot": 2, "digest": lambda window: window[:1], "buckets": 3}])
def test_hot_anchors_are_grouped_by_digest(spark, how):
    """The bound is the same however many places there are; windows that share a digest are told by their bytes."""
    docs = corpus(4)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert got(df, **how) == plain([tuple(r) for r in df.collect()])


def test_turns_of_repeated_hashes():
    """Over batch bounds as within, and the bound on hot anchors does not grow with the places."""
    draw = random.Random(3)
    hashes = sorted(draw.choices(range(-40, 40), k=300) + [100] * 50 + [200])
    batches, at = [], 0
    while at < len(hashes):
        n = draw.choice([0, 1, 2, 7, 60])
        own = hashes[at : at + n]
        batches.append(pa.record_batch({c: pa.array(own, pa.int64()) for c in ("hash", "row", "place")}))
        at += len(own)
    out = [r for b in repeats._repeated(iter(batches)) for r in b.to_pylist()]
    many = [h for h in hashes if hashes.count(h) > 1]
    assert [r["hash"] for r in out] == many
    assert [r["turn"] for r in out] == [i - many.index(h) for i, h in enumerate(many)]
    assert sorted(r["hash"] for r in out if r["turn"] == 5) == sorted({h for h in hashes if hashes.count(h) > 5})


def test_nothing_stays_in_the_catalog(spark, sf):
    before = {t.name for t in spark.catalog.listTables()}
    repeats.op10_suffix_dedup(spark, sf).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_more_partitions_than_buckets_can_be(spark):
    wide = spark.range(1).repartition(2).select(F.col("id").alias("doc_id"), F.lit("x" * 120).alias("text"))
    many = type("Many", (), {"getNumPartitions": lambda self: 60_000})()
    assert min(max(2, 2 * many.getNumPartitions()), repeats.MOST_BUCKETS) <= 100_000
    assert got(wide, buckets=1) == plain([(0, "x" * 120)])


def test_many_copies_of_one_passage():
    draw = random.Random(6)
    passage = "".join(draw.choices("abcdefgh ", k=400))
    h, first, windows, distance = repeats.anchors(passage.encode())
    place = repeats._packed(first, windows, distance)
    doc = np.repeat(np.arange(60), len(h))
    places = np.tile(place, 60)
    cut = [passage.encode()[f : f + w - 1 + LENGTH] for f, w in zip(first.tolist(), windows.tolist())] * 60
    row, start, end = repeats.later_windows(doc, doc, places, cut)
    assert (row > 0).all() and (end - start).sum() == 59 * 301


def test_small_tables(spark):
    schema = "doc_id long, text string"
    assert got(spark.createDataFrame([], schema)) == []
    assert got(spark.createDataFrame([(1, "x")], schema)) == plain([(1, "x")])


def test_query_on_its_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = [tuple(r) for r in repeats.op10_suffix_dedup(spark, sf).collect()]
    assert sorted(rows, key=str) == plain(docs)
    assert any(r[2] and r[2] < r[1] for r in rows)
