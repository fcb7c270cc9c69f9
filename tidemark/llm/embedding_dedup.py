"""Embedding near-dedup by a subspace pigeonhole join.

Vectors of length one link at a cosine of 0.95 when their squared distance is at most 0.1. They are rotated at random,
which spreads that distance evenly over the components, and split into ``BLOCKS`` blocks. By the pigeonhole principle linked
vectors are close in one block at least, within the share of the squared distance that is in proportion to the block's
components. So each block is range-joined by itself, and the union of what the blocks find is verified.

1. **Items.** A task looks for vectors that lie within half the distance of a common centre, among ``TOGETHER`` at a
   time. Such a bundle is one item from then on, so a group that a third of all rows belong to is a few rows per task, and its links
   are counted without being made. An item is a centre, written as one byte a component, and the radius within which its
   vectors lie around that code; a vector by itself is an item whose radius is the error of its code.
2. **Range join.** A block's items are dealt to leaves of a k-d tree that is cut on a bounded sample; a leaf with more than
   ``CHUNK`` items is dealt to chunks. Every two chunks whose boxes are near enough are a unit, which holds two chunks at
   most whatever the data. In a unit, tiles of a finer k-d tree whose boxes are near enough are compared by a matrix
   product that is at most zero where a pair is within the block's share, widened by the radii.
3. **Verification.** A pair that several blocks find counts in the first of them. Its distance over all components, give or
   take the radii, mostly decides it: sure links add to the counts of both items and join a spanning forest, the only
   links that leave a task. Pairs that this leaves open go to their vectors and are decided by cosines in double precision.

The result does not depend on the sample, the bundles or the chunks. On vectors without any structure the leaves' boxes all meet, so
the work grows with the square of the number of items over the chunk size; no exact join in 64 such dimensions escapes
that. What is moved is then 80 bytes per item for each chunk and block. Vectors that cluster meet their neighbours' leaves only.

Vectors that are null, zero or hold null or non-finite components link with nothing; shorter vectors count as ending
in zeros. Rows that repeat an id are vectors of their own. A null id is in its component but is never its id.
Ids are cast to long. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import partitions, scratch, settings, table
from tidemark.llm.components import components
from tidemark.llm.vectors import grouped, longest, matrix

THRESHOLD = 0.95
BLOCKS = 4
SEED = 11
#: Vectors among which a task looks for bundles, and the least that make one.
TOGETHER = 2048
LEAST = 8
#: Items of a chunk, give or take half as many; a unit holds two chunks.
CHUNK = 1 << 16
#: Items on which the leaves are cut, and the most leaves.
SAMPLE = 20_000
LEAVES = 256
TILE = 512
_SLAB = 8192
_PAIRS = 1 << 15
#: Beyond the rounding of single precision; what it lets in is tested again.
_LOOSE = 1e-5
_TINY = 1e-9

COUNT, LINK, OPEN, ROW_COUNT = range(4)
_FOUND = "kind int, a long, b long, n long"
_ITEM = "item long, code binary, scale float, radius double, size long"


def unit_vectors(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows can link, and all rows at length one (those that cannot at zero)."""
    keep, values = matrix(lists, width)
    values[~keep] = 0
    values /= np.maximum(np.abs(values).max(axis=1, initial=0), np.finfo(float).tiny)[:, None]  # no square overflows
    length = np.linalg.norm(values, axis=1)
    return keep & (length > 0), values / np.where(length > 0, length, 1)[:, None]


def coded(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components as signed bytes, and the scale of each row."""
    scale = (np.abs(centres).max(axis=1, initial=0) / 127).astype(np.float32)
    scale[scale == 0] = 1
    return np.clip(np.rint(centres / scale[:, None]), -127, 127).astype(np.int8), scale


def points(code: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return code * scale.astype(np.float64)[:, None]


class Geometry:
    """The rotation, the blocks and the distance of one join."""

    def __init__(self, width: int, threshold: float = THRESHOLD, blocks: int = BLOCKS, seed: int = SEED):
        self.given, self.threshold, self.blocks = width, threshold, blocks
        self.of_block = max(1, -(-width // blocks))
        self.width = self.of_block * blocks
        self.distance = math.sqrt(2 * (1 - threshold))
        self.rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((self.width, self.width)))[0]

    def rotated(self, units: np.ndarray) -> np.ndarray:
        return units @ self.rotation[: self.given]

    def of(self, block: int) -> slice:
        return slice(block * self.of_block, (block + 1) * self.of_block)


def bundled(where: np.ndarray, geometry: Geometry, least: int = LEAST) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each point the first of its bundle (itself if it has none), and the members of each bundle."""
    lead, bundles = np.arange(len(where)), []
    single = where.astype(np.float32)
    near = single @ single.T >= geometry.threshold
    degree = near.sum(axis=1)
    free = np.ones(len(where), bool)
    for seed in np.argsort(-degree, kind="stable").tolist():
        if degree[seed] < least:
            break
        members = np.flatnonzero(near[seed] & free) if free[seed] else np.empty(0, int)
        if len(members) < least:
            continue
        middle = points(*coded(where[members].mean(axis=0, keepdims=True)))[0]
        inside = np.linalg.norm(where[members] - middle, axis=1) <= 0.9 * geometry.distance / 2
        members = members[inside]
        if len(members) >= least:
            free[members] = False
            lead[members] = members[0]
            bundles.append(members)
    return lead, bundles


def _itemised(geometry: Geometry, least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, TOGETHER):
            n, row = batch.num_rows, batch.column("row").to_numpy()
            ids = batch.column("vec_id").to_pylist()
            own, units = unit_vectors(batch.column("vector"), geometry.given)
            at = np.flatnonzero(own)
            where = geometry.rotated(units[at])
            lead, bundles = bundled(where, geometry, least)
            centres, size, lowest = where.copy(), np.ones(n, np.int64), list(ids)
            for members in bundles:
                centres[members[0]] = where[members].mean(axis=0)
                size[at[members]] = len(members)
                known = [ids[i] for i in at[members] if ids[i] is not None]
                for i in at[members]:
                    lowest[i] = min(known, default=None)
            code, scale = coded(centres)
            off = np.linalg.norm(where - points(code[lead], scale[lead]), axis=1)
            radius = np.zeros(len(at))
            np.maximum.at(radius, lead, off + _TINY)
            leads = {int(at[i]): i for i in np.flatnonzero(lead == np.arange(len(at))).tolist()}
            item = np.zeros(n, np.int64)
            item[at] = row[at[lead]]
            pick = lambda values: [values[leads[i]] if i in leads else None for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("vec_id"), batch.column("vector"), pa.array(item, mask=~own),
                    pa.array(size), pa.array(lowest, pa.int64()),
                    pa.array(pick([c.tobytes() for c in code]), pa.binary()),
                    pa.array(pick(scale.tolist()), pa.float32()), pa.array(pick(radius.tolist()), pa.float64()),
                ],
                names=["row", "vec_id", "vector", "item", "size", "lowest", "code", "scale", "radius"],
            )

    return scan


def _codes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), width)


def split(values: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of ``values`` in parts of ``most`` at most, halved at the median of the widest component."""
    done, waiting = [], [np.arange(len(values))]
    while waiting:
        rows = waiting.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        own = values[rows]
        widest = np.argmax(own.max(axis=0) - own.min(axis=0))
        order = np.argpartition(own[:, widest], len(rows) // 2)
        waiting += [rows[order[len(rows) // 2 :]], rows[order[: len(rows) // 2]]]
    return done


class Tree:
    """A k-d tree of the same depth everywhere: component and cut of each node, children of i at 2i+1 and 2i+2."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.component, self.cut = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
        held = {0: np.arange(len(sample))}
        for node in range((1 << depth) - 1):
            own = sample[held[node]]
            if len(own):
                self.component[node] = own.std(axis=0).argmax()
                self.cut[node] = np.median(own[:, self.component[node]])
            above = own[:, self.component[node]] > self.cut[node]
            held[2 * node + 1], held[2 * node + 2] = held[node][~above], held[node][above]

    def leaf(self, values: np.ndarray) -> np.ndarray:
        node = np.zeros(len(values), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (values[np.arange(len(values)), self.component[node]] > self.cut[node])
        return node - ((1 << self.depth) - 1)


def _reach(radius: np.ndarray, geometry: Geometry) -> np.ndarray:
    """Two items can hold a link only within the sum of their reaches."""
    return radius + geometry.distance / 2


def _boxes_meet(low, high, reach, other_low, other_high, other_reach, geometry: Geometry) -> np.ndarray:
    """Whether boxes of one block can hold two points within its share of the squared distance."""
    gap = np.maximum(0, np.maximum(low - other_high, other_low - high))
    return (gap**2).sum(axis=-1) <= (reach + other_reach) ** 2 / geometry.blocks + _LOOSE


class Dealing:
    """Which units each item goes to: its chunk with every chunk whose box is near enough, block by block."""

    def __init__(self, items: DataFrame, geometry: Geometry, chunk: int, sample: int):
        self.geometry = geometry
        n = items.count()
        depth = min(int(math.log2(LEAVES)), max(0, math.ceil(math.log2(max(1, n / chunk)))))
        self.leaves = 1 << depth
        self.trees, self.salts = [], np.ones((geometry.blocks, self.leaves), np.int64)
        self.meet = np.ones((geometry.blocks, self.leaves, self.leaves), bool)
        if depth:
            some = items.orderBy(F.xxhash64("item")).limit(sample).select("code", "scale").collect()
            code = np.frombuffer(b"".join(bytes(r["code"]) for r in some), np.int8).reshape(len(some), geometry.width)
            where = points(code, np.array([r["scale"] for r in some], np.float32))
            self.trees = [Tree(where[:, geometry.of(b)], depth) for b in range(geometry.blocks)]
            self._measure(items, chunk)
        elif n > chunk:
            self.salts[:] = -(-n // chunk)
        self.units = sum(
            int(self.salts[b, i] * self.salts[b, j] if i < j else self.salts[b, i] * (self.salts[b, i] + 1) // 2)
            for b, i, j in zip(*np.nonzero(np.triu(self.meet)))
        )

    def _measure(self, items: DataFrame, chunk: int) -> None:
        geometry, leaves, leaf_of = self.geometry, self.leaves, self._leaves_of

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shape = (geometry.blocks, leaves)
            low = np.full((*shape, geometry.of_block), np.inf)
            high, reach, held = -low, np.zeros(shape), np.zeros(shape, np.int64)
            for batch in batches:
                code = _codes(batch.column("code"), geometry.width)
                where = points(code, batch.column("scale").to_numpy())
                for b, leaf in enumerate(leaf_of(where)):
                    np.minimum.at(low[b], leaf, where[:, geometry.of(b)])
                    np.maximum.at(high[b], leaf, where[:, geometry.of(b)])
                    np.maximum.at(reach[b], leaf, _reach(batch.column("radius").to_numpy(), geometry))
                    np.add.at(held[b], leaf, 1)
            full = np.flatnonzero(held.ravel())
            spread = np.repeat(full, geometry.of_block)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(spread), pa.array(np.tile(np.arange(geometry.of_block), len(full))),
                    pa.array(low.reshape(-1, geometry.of_block)[full].ravel()),
                    pa.array(high.reshape(-1, geometry.of_block)[full].ravel()),
                    pa.array(reach.ravel()[spread]), pa.array(held.ravel()[spread]),
                ],
                names=["leaf", "at", "low", "high", "reach", "held"],
            )

        # At most leaves x components numbers, whatever the number of items.
        boxes = (
            items.select("code", "scale", "radius")
            .mapInArrow(measured, "leaf long, at long, low double, high double, reach double, held long")
            .groupBy("leaf", "at").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("reach").alias("reach"), F.sum("held").alias("held"))
            .collect()
        )
        shape = (geometry.blocks * leaves, geometry.of_block)
        low, high, reach = np.full(shape, np.inf), np.full(shape, -np.inf), np.zeros(shape[0])
        salts = self.salts.reshape(-1)
        for r in boxes:
            low[r["leaf"], r["at"]], high[r["leaf"], r["at"]], reach[r["leaf"]] = r["low"], r["high"], r["reach"]
            salts[r["leaf"]] = -(-r["held"] // (chunk + chunk // 2))  # a leaf a little over is not worth four units
        for b in range(geometry.blocks):
            own = slice(b * leaves, (b + 1) * leaves)
            for i in range(leaves):
                self.meet[b, i] = _boxes_meet(
                    low[own][i], high[own][i], reach[own][i], low[own], high[own], reach[own], geometry
                )

    def _leaves_of(self, where: np.ndarray) -> list[np.ndarray]:
        if not self.trees:
            return [np.zeros(len(where), np.int64)] * self.geometry.blocks
        return [tree.leaf(where[:, self.geometry.of(b)]) for b, tree in enumerate(self.trees)]

    def units_of(self, item: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit, side and position of the item, for each unit an item goes to."""
        units, sides, rows = [], [], []
        mixed = (item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        for b, leaf in enumerate(self._leaves_of(where)):
            salt = (mixed % self.salts[b, leaf].astype(np.uint64)).astype(np.int64)
            for i in np.unique(leaf).tolist():
                own = np.flatnonzero(leaf == i)
                for j in np.flatnonzero(self.meet[b, i] | self.meet[b, :, i]).tolist():
                    for other in range(int(self.salts[b, j])):
                        s = salt[own]
                        second = (i > j) | ((i == j) & (s > other))
                        first_leaf, second_leaf = min(i, j), max(i, j)
                        a = np.where(second, other, s) if i != j else np.minimum(s, other)
                        c = np.where(second, s, other) if i != j else np.maximum(s, other)
                        units.append((((b << 8 | first_leaf) << 8 | second_leaf) << 40) | a << 20 | c)
                        sides.append(np.broadcast_to(second, len(own)).astype(np.int32))
                        rows.append(own)
        if not units:
            return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)
        return np.concatenate(units), np.concatenate(sides), np.concatenate(rows)


def _dealt(dealing: Dealing):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = _codes(batch.column("code"), dealing.geometry.width)
            where = points(code, batch.column("scale").to_numpy())
            unit, side, row = dealing.units_of(batch.column("item").to_numpy(), where)
            for at in range(0, len(unit), 1 << 14):
                own = batch.take(pa.array(row[at : at + (1 << 14)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit[at : at + (1 << 14)]), pa.array(side[at : at + (1 << 14)]), *own.columns],
                    names=["unit", "side", *own.schema.names],
                )

    return scan


class _Chunk:
    """Items of one side of a unit, in the order of their tiles in the unit's block."""

    def __init__(self, held: pa.Table, block: int, geometry: Geometry):
        code = _codes(held.column("code").combine_chunks(), geometry.width)
        scale = held.column("scale").to_numpy()
        tiles = split(code[:, geometry.of(block)] * scale[:, None], TILE)
        order = np.concatenate(tiles)
        self.item, self.size = held.column("item").to_numpy()[order], held.column("size").to_numpy()[order]
        self.radius = held.column("radius").to_numpy()[order]
        self.code, self.scale = code[order], scale[order]
        self.reach = _reach(self.radius, geometry)
        ends = np.cumsum([len(t) for t in tiles])
        self.bounds = np.concatenate(([0], ends))
        own = self.code[:, geometry.of(block)] * self.scale[:, None]
        starts = self.bounds[:-1]
        self.low, self.high = np.minimum.reduceat(own, starts), np.maximum.reduceat(own, starts)
        self.far = np.maximum.reduceat(self.reach, starts)
        share = (1 / math.sqrt(geometry.blocks) * self.reach).astype(np.float32)
        # left @ right.T = squared distance - (sum of reaches)^2 / blocks
        square = (own**2).sum(axis=1) - share**2
        one = np.ones(len(own), np.float32)
        self.left = np.column_stack((own, share, square, one)).astype(np.float32)
        self.right = np.column_stack((-2 * own, -2 * share, one, square)).astype(np.float32)

    def points(self, rows: np.ndarray) -> np.ndarray:
        return points(self.code[rows], self.scale[rows])


def _close(a: _Chunk, b: _Chunk, same: bool, geometry: Geometry) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions that the block may hold within its share."""
    for t in range(len(a.bounds) - 1):
        meet = _boxes_meet(a.low[t], a.high[t], a.far[t], b.low, b.high, b.far, geometry)
        if same:
            meet[:t] = False
        tiles = np.flatnonzero(meet)
        if not len(tiles):
            continue
        others = np.concatenate([np.arange(b.bounds[u], b.bounds[u + 1]) for u in tiles])
        left = a.left[a.bounds[t] : a.bounds[t + 1]]
        for at in range(0, len(others), _SLAB):
            slab = others[at : at + _SLAB]
            product = left @ b.right[slab].T
            if product.min() > _LOOSE:
                continue
            x, y = np.nonzero(product <= _LOOSE)
            x, y = x + a.bounds[t], slab[y]
            if same:
                x, y = x[x < y], y[x < y]
            for piece in range(0, len(x), _PAIRS):
                yield x[piece : piece + _PAIRS], y[piece : piece + _PAIRS]


class _Forest:
    """Which of the first n numbers are connected; a node's label is a smaller node of its tree, or itself."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            x, y = self.label[x], self.label[y]
            apart = x != y
            x, y = np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            np.minimum.at(self.label, x, y)
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def joined(block: int, home: pa.Table, guests: pa.Table | None, geometry: Geometry) -> pa.RecordBatch:
    """Counts, a spanning forest of the sure links, and the pairs left open, of one unit."""
    a = _Chunk(home, block, geometry)
    b = a if guests is None else _Chunk(guests, block, geometry)
    shift = 0 if guests is None else len(a.item)
    item = a.item if guests is None else np.concatenate((a.item, b.item))
    size = a.size if guests is None else np.concatenate((a.size, b.size))
    found, forest, opened = np.zeros(len(item), np.int64), _Forest(len(item)), []
    for x, y in _close(a, b, guests is None, geometry):
        # Component by component, so that each unit that meets the pair comes to the same numbers.
        apart = ((a.points(x) - b.points(y)) ** 2).reshape(len(x), geometry.blocks, geometry.of_block)
        by_block = np.zeros((len(x), geometry.blocks))
        for t in range(geometry.of_block):
            by_block += apart[:, :, t]
        within = by_block <= ((a.reach[x] + b.reach[y]) ** 2 / geometry.blocks)[:, None] + _TINY
        mine = within[:, block] & ~within[:, :block].any(axis=1)
        distance = np.sqrt(by_block.sum(axis=1))
        radii = a.radius[x] + b.radius[y]
        sure = mine & (distance + radii <= geometry.distance - _TINY)
        unsure = mine & ~sure & (distance - radii <= geometry.distance + _TINY)
        x_all, y_all = x, y + shift
        x, y = x_all[sure], y_all[sure]
        np.add.at(found, x, size[y])
        np.add.at(found, y, size[x])
        forest.join(x, y)
        if unsure.any():
            opened.append((item[x_all[unsure]], item[y_all[unsure]]))
    counted = np.flatnonzero(found)
    child = np.flatnonzero(forest.label != np.arange(len(item)))
    open_a, open_b = (np.concatenate(c) for c in zip(*opened)) if opened else (np.empty(0, np.int64),) * 2
    sizes = (len(counted), len(child), len(open_a))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.array([COUNT, LINK, OPEN], np.int32), sizes)),
            pa.array(np.concatenate((item[counted], item[child], open_a))),
            pa.array(np.concatenate((np.zeros(sizes[0], np.int64), item[forest.label[child]], open_b))),
            pa.array(np.concatenate((found[counted], np.zeros(sizes[1] + sizes[2], np.int64)))),
        ],
        names=["kind", "a", "b", "n"],
    )


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each key of a partition that is sorted by it."""
    held: list[pa.RecordBatch] = []
    own = None
    for batch in batches:
        keys = batch.column(key).to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)])) if len(keys) else []
        for start, end in zip(edges[:-1], edges[1:]):
            if keys[start] != own:
                if held:
                    yield own, pa.Table.from_batches(held)
                held, own = [], int(keys[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield own, pa.Table.from_batches(held)


def _units(geometry: Geometry):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rows in _by_key(batches, "unit"):
            cut = int(np.searchsorted(rows.column("side").to_numpy(), 1))
            first, second, salts = unit >> 48 & 255, unit >> 40 & 255, unit & ((1 << 40) - 1)
            alone = first == second and salts >> 20 == salts & ((1 << 20) - 1)
            if not cut or (not alone and cut == rows.num_rows):
                continue  # a chunk without items has nothing to meet
            yield joined(unit >> 56, rows.slice(0, cut), None if alone else rows.slice(cut), geometry)

    return scan


def _decided(geometry: Geometry):
    """Open pairs by the cosines of their vectors: counts per row, and a link where any of the vectors do."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_key(batches, "pair"):
            cut = int(np.searchsorted(rows.column("side").to_numpy(), 1))
            _, units = unit_vectors(rows.column("vector").combine_chunks(), geometry.given)
            linked = units[:cut] @ units[cut:].T >= geometry.threshold
            if not linked.any():
                continue
            row, item = rows.column("row").to_numpy(), rows.column("item").to_numpy()
            counts = np.concatenate((linked.sum(axis=1), linked.sum(axis=0)))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([LINK] + [ROW_COUNT] * len(some), pa.int32()),
                    pa.array([item[0], *row[some]], pa.int64()),
                    pa.array([item[-1]] + [0] * len(some), pa.int64()),
                    pa.array([0, *counts[some]], pa.int64()),
                ],
                names=["kind", "a", "b", "n"],
            )

    return scan


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
    blocks: int = BLOCKS, least: int = LEAST, chunk: int = CHUNK, sample: int = SAMPLE,
) -> DataFrame:
    """vec_id, n_links, component_id of every row."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")
    )
    geometry = Geometry(longest(rows, "vector"), threshold, blocks)
    kind = dict(rows.dtypes)["vector"]
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="4096"):
        members = scratch(
            rows.mapInArrow(
                _itemised(geometry, least),
                f"row long, vec_id long, vector {kind}, item long, size long, lowest long, code binary, scale float, radius double",
            ),
            "vectors",
        )
        items = members.where("code IS NOT NULL").select("item", "code", "scale", "radius", "size")
        dealing = Dealing(items, geometry, chunk, sample)
        dealt = items.mapInArrow(_dealt(dealing), f"unit long, side int, {_ITEM}")
        many = max(partitions(spark), min(2 * dealing.units, 20_000))
        found = scratch(
            dealt.repartition(many, "unit").sortWithinPartitions("unit", "side").mapInArrow(_units(geometry), _FOUND),
            "vector-links",
        )
        opened = found.where(F.col("kind") == OPEN)
        if not opened.isEmpty():
            pairs = scratch(opened.select(F.monotonically_increasing_id().alias("pair"), "a", "b"), "open-pairs")
            ends = pairs.select("pair", F.lit(0).alias("side"), F.col("a").alias("item")).union(pairs.select("pair", F.lit(1), "b"))
            met = ends.join(members.select("item", "row", "vector"), "item").select("pair", "side", "item", "row", "vector")
            decided = met.repartition("pair").sortWithinPartitions("pair", "side").mapInArrow(_decided(geometry), _FOUND)
            found = found.unionByName(scratch(decided, "decided-pairs"))

    def counts(which: int, key: str) -> DataFrame:
        return found.where(F.col("kind") == which).groupBy(F.col("a").alias(key)).agg(F.sum("n").alias(f"by_{key}"))

    roots = components(found.where(F.col("kind") == LINK).select("a", "b"))
    linked = members.where("code IS NOT NULL").select("item", "lowest").join(roots, F.col("item") == F.col("node"))
    least_id = linked.groupBy("root").agg(F.min("lowest").alias("component_id"))
    moved = linked.join(least_id, "root").select("item", "root", "component_id")
    zero = F.lit(0).cast("long")
    return (
        members.select("row", "vec_id", "item", "size", "lowest")
        .join(counts(COUNT, "item"), "item", "left").join(counts(ROW_COUNT, "row"), "row", "left").join(moved, "item", "left")
        .select(
            "vec_id",
            F.when(F.col("item").isNull(), zero)
            .otherwise(F.col("size") - 1 + F.coalesce("by_item", zero) + F.coalesce("by_row", zero)).alias("n_links"),
            F.when(F.col("root").isNull(), F.col("lowest")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = rf"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), classes AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY 1
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM classes LEFT JOIN n USING (vec_id)
"""
