"""SimHash near-dedup with multi-index hashing.

A fingerprint is cut into two halves of 32 bits. Fingerprints at four or fewer differing bits agree to two bits in
one half at least, so the balls of radius one around those halves meet. Every different fingerprint is filed under
the 33 keys of each half's ball, and looked up under the same; what meets under a key is verified over all 64 bits.
Both sides reach one bit, so a fingerprint is filed 66 times instead of the 1,058 of a one-sided ball, and a key
still has 32 bits: by chance alone it gets a second fingerprint only beyond a hundred million different ones.

Only different fingerprints are filed, so copies cost nothing. A key's links leave its task as a spanning forest,
never as pairs. Keys with more than ``CROWDED`` fingerprints are not compared pairwise: their fingerprints are
filed under every point of their own radius-two ball of 64 bits instead. Two that share a point are linked without
a comparison, and any two within four bits share one, so that way is exact too and linear in the crowd. Keys that
would hold over a thousandth of all fingerprints are found on a sample beforehand and never meet in one task.

Null and empty texts have no words; their fingerprint is zero and links like any other. Rows that repeat a document
get a row each. A null doc_id is in its component but is never its id. Ids are cast to long. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import scratch, table
from tidemark.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: A key with more fingerprints is linked through balls of 64 bits instead of pairwise.
CROWDED = 4096
#: Fingerprints on which overfull keys are looked for.
SAMPLE = 20_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_PIECE = 1 << 16


def fingerprint(text: bytes | None) -> int:
    words = [w for w in text.translate(_FOLD).split(b" ") if w] if text else []
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: n - SHINGLE + 1], ends.tolist()[SHINGLE - 1 :])]
    raised = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PIECE):
        piece = np.array(hashes[at : at + _PIECE], ">u8").view(np.uint8).reshape(-1, 8)
        raised += np.unpackbits(piece, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(raised * 2 > len(hashes)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), and ``row_col`` (long) if it is given."""
    carried = [row_col] if row_col else []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values.view(np.int64)), *map(batch.column, carried)],
                names=["doc_id", "fp", *carried],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *carried)
    return rows.mapInArrow(scan, ", ".join(f"{c} long" for c in ["doc_id", "fp", *carried]))


def _forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what a chain of distances within bounds connects."""
    links, left = [], members
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= DISTANCE
            if near.any():
                found = left[near]
                left = left[~near]
                links += [(x, y) for y in found]
                front += list(found)
    return links


def _keys(fp: Column) -> Column:
    """Both halves' balls of radius one; the lower half's keys have a bit of their own."""
    masks = F.array(*[F.lit(m).cast("long") for m in [0, *(1 << b for b in range(32))]])
    upper = F.shiftrightunsigned(fp, 32)
    lower = fp.bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1 << 40))
    return F.concat(F.transform(masks, upper.bitwiseXOR), F.transform(masks, lower.bitwiseXOR))


def _met(crowded: int):
    """Links under each key of a partition sorted by key; the members of a crowded key go on as they are."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, spilt = None, [], False

        def close(out):
            if spilt:
                return
            members = np.concatenate(held) if held else np.empty(0, np.uint64)
            out += [(a, b, False) for a, b in _forest(members)]

        def batch_of(out):
            a = np.array([x[0] for x in out], np.uint64).view(np.int64)
            b = np.array([x[1] for x in out], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array([x[2] for x in out], pa.bool_())], names=["a", "b", "crowded"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple] = []
            keys = batch.column("key").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            edges = np.flatnonzero(np.diff(keys)) + 1
            starts = np.concatenate(([0], edges))
            ends = np.concatenate((edges, [len(keys)]))
            # Keys with one member in this batch matter only if the key goes on in another batch.
            matter = np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(keys)))
            for s, e in zip(starts[matter].tolist(), ends[matter].tolist()):
                if keys[s] != held_key:
                    close(out)
                    held_key, held, spilt = keys[s], [], False
                held.append(fps[s:e])
                if spilt or sum(map(len, held)) > crowded:
                    out += [(x, x, True) for piece in held for x in piece]
                    held, spilt = [], True
            if out:
                yield batch_of(out)
        out = []
        close(out)
        if out:
            yield batch_of(out)

    return scan


def _through_points(fps: DataFrame) -> DataFrame:
    """Links among crowded fingerprints: each with the least that shares a point of its radius-two ball."""
    flips = [0, *(1 << b for b in range(64)), *((1 << a) | (1 << b) for a, b in combinations(range(64), 2))]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in flips])
    points = fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    return points.join(least, "point").where("fp <> least").select(
        F.col("least").alias("a"), F.col("fp").alias("b")
    ).distinct()


def links(fps: DataFrame, n: int, crowded: int = CROWDED, sample: int = SAMPLE) -> DataFrame:
    """a, b: links that connect the different fingerprints ``fps`` (fp; ``n`` rows) wherever four bits or fewer do."""
    filed = fps.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    rate = min(1.0, sample / max(n, 1))
    bound = max(crowded, n / 1000) * rate
    heavy = filed if rate == 1 else fps.where(
        F.pmod(F.xxhash64("fp"), F.lit(1_000_000)) < F.lit(round(rate * 1_000_000))
    ).select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    # At most 66 keys for each thousandth of the fingerprints can be this full.
    heavy = scratch(heavy.groupBy("key").count().where(F.col("count") > bound).select("key"), "heavy-keys")
    any_heavy = not heavy.isEmpty()
    apart = filed.join(F.broadcast(heavy), "key", "left_anti") if any_heavy else filed
    met = scratch(
        apart.repartition("key").sortWithinPartitions("key").select("key", "fp")
        .mapInArrow(_met(crowded), "a long, b long, crowded boolean"),
        "met",
    )
    found = met.where("not crowded").select("a", "b")
    crowd = met.where("crowded").select(F.col("a").alias("fp"))
    if any_heavy:
        crowd = crowd.union(filed.join(F.broadcast(heavy), "key", "left_semi").select("fp"))
    if not crowd.isEmpty():
        found = found.union(_through_points(scratch(crowd.distinct(), "crowd")))
    return found


def _classes(marked: DataFrame) -> DataFrame:
    """fp, root (one fingerprint of its component) and component_id for every different fingerprint."""
    different = scratch(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "different")
    roots = components(links(different.select("fp"), different.count()))
    linked = different.join(roots, different["fp"] == roots["node"]).select("fp", "first_id", "root")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component"))
    moved = linked.join(least, "root").select("fp", "root", "component")
    return different.join(moved, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id for every row."""
    marked = scratch(fingerprints(docs, id_col, text_col), "fingerprints")
    return marked.join(_classes(marked), "fp").select("doc_id", "fp", "component_id")


def near_copies(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_col`` of all rows but one of each component. Of rows with its least id, the least number stays."""
    marked = scratch(fingerprints(docs, id_col, text_col, row_col), "fingerprints")
    wins = F.col("doc_id").eqNullSafe(F.col("component_id"))
    placed = scratch(marked.join(_classes(marked), "fp").select(row_col, "root", wins.alias("wins")), "near-copies")
    first = placed.where("wins").groupBy("root").agg(F.min(row_col).alias(row_col))
    return placed.join(first, row_col, "left_anti").select(row_col)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
