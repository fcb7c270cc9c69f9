"""Links and components against all pairs, on clusters, near the threshold, and through many chunks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import embedding_dedup as dedup

KIND = "vec_id long, embedding array<double>, label int"


def plain(rows: list[tuple]) -> list[tuple]:
    """vec_id, n_links and component_id of each row, in order."""
    width = max([len(v) for _, v in rows if v is not None], default=0)
    units = np.zeros((len(rows), width))
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            units[i, : len(v)] = np.array(v) / max(map(abs, v))
            units[i] /= np.linalg.norm(units[i])
    linked = units @ units.T >= 0.95
    np.fill_diagonal(linked, False)
    out, component = [], list(range(len(rows)))
    for i in range(len(rows)):
        for j in np.flatnonzero(linked[i, :i]):
            old, new = sorted((component[i], component[j]), reverse=True)
            component = [new if c == old else c for c in component]
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if component[j] == component[i] and rows[j][0] is not None]
        out.append((vec_id, int(linked[i].sum()), min(ids, default=None)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(i, v, None) for i, v in rows], KIND).repartition(parts)
    got = [tuple(r) for r in dedup.near_duplicates(df, **how).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def clusters(draw, n: int, width: int, spread: float) -> np.ndarray:
    """Half of the vectors in one cluster, a quarter in small ones, the rest apart."""
    centres = draw.standard_normal((n, width))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    of = np.where(np.arange(n) < n // 2, 0, np.where(np.arange(n) < 3 * n // 4, np.arange(n) // 5, np.arange(n)))
    return centres[of] + spread * draw.standard_normal((n, width)) / math.sqrt(width)


@pytest.mark.parametrize("how", [{"spread": 0.2}, {"spread": 0.05, "chunk": 90, "sample": 50, "blocks": 2, "least": 10**9}])
def test_clusters(spark, how):
    values = clusters(np.random.default_rng(3), 240, 24, how.pop("spread"))
    check(spark, [(7 * i % 240, v.tolist()) for i, v in enumerate(values)], **how)


def test_near_the_threshold(spark):
    """Pairs whose cosine is within a thousandth of the threshold are decided by their vectors, in bundles or not."""
    draw, rows = np.random.default_rng(5), []
    for i in range(30):
        a, b = np.linalg.qr(draw.standard_normal((16, 2)))[0].T
        cosine = 0.95 + (i - 15) * 1e-4 + 1e-7
        rows += [(3 * i, a.tolist()), (3 * i + 1, (5 * (cosine * a + math.sqrt(1 - cosine**2) * b)).tolist())]
    a, b = np.linalg.qr(draw.standard_normal((16, 2)))[0].T
    angle = math.acos(0.95)
    for i in range(40):  # two bundles, some of whose members link
        t = (angle + 0.02) * (i % 2) + 0.0009 * (i // 2)
        rows.append((1000 + i, (math.cos(t) * a + math.sin(t) * b).tolist()))
    check(spark, rows, parts=1)


def test_odd_vectors(spark):
    ones = [1.0] * 6
    rows = [
        (5, ones), (5, ones), (3, ones), (None, ones), (None, None), (8, None), (9, [0.0] * 6), (10, []), (11, [1.0, None] * 3),
        (12, [math.nan] + ones[1:]), (13, [math.inf] + ones[1:]), (14, [1e300] * 6), (15, [1e-300] * 6), (16, [5e-324] * 6),
        (17, [-1.0] * 6), (18, [1.0]), (19, [2.0, 0.0]), (None, [0.0, 1.0]), (-4, [0.0, 3.0, 0.1]),
    ]
    check(spark, rows)
    check(spark, [(1, None)])


def test_hot_copies_are_few_items(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)] + [(5000 + i, [4.0, 3.0 + i, 2.0, -1.0]) for i in range(20)]
    check(spark, rows)
    geometry = dedup.Geometry(4)
    batch = pa.record_batch(
        {"row": pa.array(range(2048)), "vec_id": pa.array(range(2048)), "vector": pa.array([[1.0, 2.0, 3.0, 4.0]] * 2048)}
    )
    made = pa.Table.from_batches(dedup._itemised(geometry, 8)(iter([batch])))
    assert made.column("code").null_count == 2047


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], KIND)
    assert dedup.near_duplicates(empty).collect() == []
    clash = spark.createDataFrame(
        [(1, [1.0, 0.0], 1, 2, 3, 4), (2, [1.0, 0.1], 1, 2, 3, 4)],
        "vec_id int, embedding array<float>, row int, item int, size int, component_id int",
    )
    got = sorted(tuple(r) for r in dedup.near_duplicates(clash).collect())
    assert got == [(1, 1, 1), (2, 1, 1)]


def test_units_cover_every_close_pair_once(spark):
    """Whatever the leaves and chunks, a pair that can link meets in exactly one unit of each block that may hold it."""
    draw = np.random.default_rng(1)
    geometry = dedup.Geometry(12)
    where = geometry.rotated(clusters(draw, 400, 12, 0.3))
    where /= np.linalg.norm(where, axis=1)[:, None]
    code, scale = dedup.coded(where)
    off = np.linalg.norm(where - dedup.points(code, scale), axis=1)
    items = spark.createDataFrame(
        [(i, bytearray(code[i].tobytes()), float(scale[i]), float(off[i]), 1) for i in range(400)], dedup._ITEM
    )
    dealing = dedup.Dealing(items, geometry, 30, 100)
    assert dealing.leaves > 1 and dealing.salts.max() > 1
    unit, side, row = dealing.units_of(np.arange(400), dedup.points(code, scale))
    assert dealing.units >= len(set(unit.tolist()))
    held: dict[int, list] = {}
    for u, s, r in zip(unit.tolist(), side.tolist(), row.tolist()):
        held.setdefault(u, []).append((s, r))
    met: dict[tuple, int] = {}
    for u, own in held.items():
        alone = (u >> 48 & 255) == (u >> 40 & 255) and (u >> 20 & 0xFFFFF) == (u & 0xFFFFF)
        for s, r in own:
            for t, q in own:
                if (alone and r < q) or (not alone and s < t):
                    pair = (u >> 56, min(r, q), max(r, q))
                    met[pair] = met.get(pair, 0) + 1
    assert set(met.values()) == {1}
    near = np.linalg.norm(where[:, None] - where[None], axis=2) <= geometry.distance
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        assert any((b, i, j) in met for b in range(geometry.blocks))


def test_same_pairs_whatever_the_order_in_a_unit():
    """A unit of one chunk and the two halves of it against each other find the same."""
    draw = np.random.default_rng(2)
    geometry = dedup.Geometry(16)
    where = geometry.rotated(clusters(draw, 300, 16, 0.25))
    where /= np.linalg.norm(where, axis=1)[:, None]
    code, scale = dedup.coded(where)
    off = np.linalg.norm(where - dedup.points(code, scale), axis=1)
    rows = pa.table({
        "item": pa.array(range(300)), "code": pa.array([c.tobytes() for c in code]), "scale": pa.array(scale),
        "radius": pa.array(off), "size": pa.array([1] * 300),
    })

    def counts(batches):
        out: dict[int, int] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == dedup.COUNT:
                    out[r["a"]] = out.get(r["a"], 0) + r["n"]
        return out

    for block in range(geometry.blocks):
        whole = counts([dedup.joined(block, rows, None, geometry)])
        a, b = rows.slice(0, 110), rows.slice(110)
        halves = [dedup.joined(block, a, None, geometry), dedup.joined(block, b, None, geometry), dedup.joined(block, a, b, geometry)]
        assert counts(halves) == whole
