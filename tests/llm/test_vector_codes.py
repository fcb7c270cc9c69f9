"""Orchard's search against every entry, the training against plain loops."""

from __future__ import annotations

import hashlib
import math

import numpy as np

from tidemark.llm import vector_codes
from tidemark.llm.vectors import grouped, matrix

KIND = "vec_id long, embedding array<double>, label int"


def plain(rows: list[tuple], parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label) of each kept row, and the codebooks in decimal."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return [], ""
    width = max(1, math.ceil(max(len(r[1]) for r in rows if r[1] is not None) / parts)) * parts
    size = width // parts
    cut = 1 << 24
    ints = [[max(-cut, min(cut, math.floor(x * 256))) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, ints[i]))[:entries]
    books = [[ints[i][p * size : (p + 1) * size] for i in first] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(e, v)), i) for i, e in enumerate(books[p]))

    for turn in range(rounds + 1):
        found = [[nearest(p, v[p * size : (p + 1) * size]) for p in range(parts)] for v in ints]
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p * size : (p + 1) * size] for v, f in zip(ints, found) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out = [(r[0], [i for _, i in f], sum(d for d, _ in f), r[2]) for r, f in zip(kept, found)]
    return out, ",".join(str(x) for book in books for entry in book for x in entry)


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def check(spark, rows, **how):
    made = vector_codes.VectorCodes(spark.createDataFrame(rows, KIND).repartition(3), **how)
    got = [(r["vec_id"], list(r["code"]), r["error"], r["label"]) for r in made.codes().collect()]
    want, written = plain(rows, **how)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert (made.codebooks.written() if made.codebooks else "") == written


def test_search_finds_the_nearest_entry_and_the_lower_of_two():
    draw = np.random.default_rng(1)
    for spread in (2, 5, 300):  # few different values make many ties and equal entries
        for size in (1, 2, 17, 64):
            books = vector_codes.Codebooks(draw.integers(-spread, spread, (3, size, 4)))
            vectors = draw.integers(-spread - 1, spread + 1, (200, 3, 4))
            code, far = books.assign(vectors)
            every = ((vectors[:, :, None] - books.entries[None]) ** 2).sum(axis=3)
            assert (code == every.argmin(axis=2)).all() and (far == every.min(axis=2)).all()


def test_training(spark):
    draw = np.random.default_rng(2)
    rows = [(int(i), draw.normal(0, 0.2, 32).astype(np.float32).tolist(), int(i) % 3 if i % 4 else None) for i in draw.permutation(150)]
    check(spark, rows)
    check(spark, rows, entries=5, rounds=4, parts=4)


def test_odd_vectors(spark):
    row = [0.5, -0.25] * 8
    rows = [
        (3, row, 1), (3, row, 1), (3, row[::-1], None), (None, row, 2), (4, None, 1), (5, [1.0, None] * 8, 1),
        (6, [math.nan] * 16, 1), (7, [math.inf] * 16, 1), (8, [1e300] * 16, 1), (9, [-1e300] * 16, 1), (10, [0.1], 1), (11, [], 1),
        (12, [0.1] * 17, 5),
    ]
    check(spark, rows)
    check(spark, rows[:1])
    check(spark, rows[4:8])


def test_empty_and_clashing_columns(spark):
    check(spark, [])
    df = spark.createDataFrame([(1, [0.5] * 16, "a", 9, 9)], "vec_id int, embedding array<float>, label string, code int, error int")
    (r,) = vector_codes.VectorCodes(df).codes().collect()
    assert (r["vec_id"], r["label"], r["error"]) == (1, "a", 0)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, written = plain(rows)
    of_label: dict = {}
    for _, _, error, label in want:
        of_label[label] = of_label.get(label, 0) + error
    digest = hashlib.sha256(written.encode()).hexdigest()
    expected = {(i, "".join(f"{c:02x}" for c in code), e, of_label[label], digest) for i, code, e, label in want}
    assert {tuple(r) for r in vector_codes.op13_vector_codes(spark, sf).collect()} == expected


def test_matrix_and_grouped():
    import pyarrow as pa

    lists = pa.array([[1.0, 2.0], None, [], [3.0], [None, 1.0]], pa.list_(pa.float32())).slice(1)
    keep, values = matrix(lists, 2)
    assert keep.tolist() == [False, True, True, False] and values[:3].tolist() == [[0, 0], [0, 0], [3, 0]]
    batches = [pa.record_batch({"x": pa.array(range(a, b), pa.int64())}) for a, b in ((0, 3), (3, 3), (3, 11), (11, 12))]
    assert [b.column("x").to_pylist() for b in grouped(iter(batches), 5)] == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9], [10, 11]]
    assert list(grouped(iter([]), 5)) == []
