"""Suffix-array dedup: bytes covered by a string of 100 bytes that also starts earlier.

Sorting every suffix of a corpus is not needed to know which windows of 100 bytes are first of their kind:

1. Every window has an anchor: of its 69 strings of 32 bytes the one with the least hash, the leftmost if several. Equal
   windows have equal anchors at equal places. Neighbouring windows mostly share theirs, so a text has about one
   anchor in 35 bytes, each with the windows it stands for.
2. Anchors are shuffled by hash, as three numbers; those that occur once have no equal window and go no further.
3. The others fetch their context, the bytes of their windows, and are shuffled by hash again. Within a task the
   suffixes at the anchors are sorted by deep-shallow sorting (``suffixes``), and so are the reversed prefixes. Two
   windows at the same distance from their anchor are equal when the suffixes agree to the window's end and the
   prefixes to its start, which the common prefixes of sorted neighbours tell for all windows at once.
4. Windows that are not the first of theirs mark their bytes; a document's marks are united and cut out.

Copies of whole texts are found by digest before and only their first row is searched: the rest is marked whole. Anchors in
over ``HOT`` places are not sorted: their windows are grouped by digest and bytes, which combines map-side, so no group
meets in one task. The windows of a digest then find their first by the digest alone, once it is known that no
other bytes have it; those of a digest that several share are matched by their bytes. Most hot anchors are counted where the anchors
meet by hash; those that a thousandth of all places share (a passage in a third of all documents) would be too many
there already and are found on a sample beforehand.

Texts are written once as a table bucketed by the partition they were read in, so contexts and marks come to
them and no text is shuffled. Matches are judged on the input, never cross texts, and whole texts are searched.

Null texts count as empty. Rows are ordered by doc_id, null ids last, then as stored; rows that repeat an id are
documents of their own. Ids are cast to long. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import bucketed, discard, discard_table, scratch, settings, table
from tidemark.llm.suffixes import deep_shallow

LENGTH = 100
GRAM = 32
PLACES = LENGTH - GRAM + 1
#: Anchors in more places than this are grouped by digest instead of sorted.
HOT = 20_000
#: Anchors on which those are looked for that a thousandth of all places share.
SAMPLE = 200_000
#: Spark takes 100,000 at most, whatever the input's partitions.
MOST_BUCKETS = 50_000
#: Contexts sorted together; a larger group is sorted alone.
TOGETHER = 20_000

_PIECE = 1 << 20
_POSITION = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15
_LAST_ID = (1 << 63) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, _PIECE + LENGTH)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _PIECE + LENGTH)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the string of 32 bytes at each place: a polynomial from prefix sums, then mixed."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
    h = (sums[GRAM:] - sums[:-GRAM]) * _DOWN[: n - GRAM + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first window, windows, and distance of the anchor from the first window's start, of each anchor."""
    out = []
    for base in range(0, len(text) - LENGTH + 1, _PIECE):
        raw = np.frombuffer(text, np.uint8)[base : base + _PIECE + LENGTH - 1]
        h = gram_hashes(raw)
        least = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while 2 * span <= PLACES:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < PLACES:
            least = np.minimum(least[: len(least) - PLACES + span], least[PLACES - span :])
        at = (least & _POSITION).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], np.diff(at) != 0)))
        out.append((h[at[starts]], starts + base, np.diff(np.append(starts, len(at))), at[starts] - starts))
    if not out:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def _packed(first: np.ndarray, windows: np.ndarray, distance: np.ndarray) -> np.ndarray:
    return first << 16 | windows << 8 | distance


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, place >> 8 & 255, place & 255


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, rows, places = [], [], []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
            h, first, windows, distance = anchors(text.as_py())
            hashes.append(h.view(np.int64))
            rows.append(np.full(len(h), row))
            places.append(_packed(first, windows, distance))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (hashes, rows, places)], names=["hash", "row", "place"]
            )


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by hash, the rows whose hash another row has, and which of its rows each is, from 0."""
    names = ["hash", "row", "place", "turn"]
    held, turn = None, 0  # the last row so far, and which of its hash it is
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy() for c in batch.columns]
        if held is not None:
            now = [np.concatenate((a, b)) for a, b in zip(held, now)]
        equal = np.diff(now[0]) == 0
        first = np.flatnonzero(np.concatenate(([True], ~equal)))
        turns = np.arange(len(now[0])) - np.repeat(first, np.diff(np.append(first, len(now[0]))))
        turns[: first[1] if len(first) > 1 else None] += turn  # the first group may have begun before
        keep = (turns > 0) | np.append(equal, False)
        held, turn = [c[-1:] for c in now], int(turns[-1])
        yield pa.RecordBatch.from_arrays([pa.array(c[:-1][keep[:-1]]) for c in (*now, turns)], names=names)
    if turn:
        yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in held), pa.array([turn])], names=names)


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each anchor's windows."""
    for batch in batches:
        doc, row = batch.column("doc").to_pylist(), batch.column("row").to_pylist()
        out: list[tuple] = []
        for i, (text, own) in enumerate(zip(batch.column("text"), batch.column("own").to_pylist())):
            raw = text.as_py()
            for x in own:
                first, windows = x["place"] >> 16, x["place"] >> 8 & 255
                out.append((x["hash"], doc[i], row[i], x["place"], raw[first : first + windows - 1 + LENGTH]))
        columns = list(zip(*out)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["hash", "doc", "row", "place", "context"]
        )


def later_windows(doc, row, place, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and end of each run of windows that equal an earlier one; all anchors of equal hash must be here."""
    first, windows, distance = _unpacked(place)
    turn = np.lexsort((first, row, doc))  # from here on, what comes earlier has the smaller number
    row, first, windows, distance = row[turn], first[turn], windows[turn], distance[turn]
    contexts = [contexts[i] for i in turn.tolist()]
    n = len(contexts)
    ranks = []
    for side in (
        [c[d:] for c, d in zip(contexts, distance.tolist())], [c[:d][::-1] for c, d in zip(contexts, distance.tolist())]
    ):
        order, shared = deep_shallow(side)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        ranks.append((rank, shared))
    (after_rank, after), (before_rank, before) = ranks
    later = np.zeros((n, PLACES), bool)  # by the distance of the window's start from the anchor
    for d in range(PLACES):
        own = np.flatnonzero((distance >= d) & (distance - windows < d))
        if len(own) < 2:
            continue
        key = np.cumsum(after < LENGTH - d)[after_rank[own]] * (n + 1) + np.cumsum(before < d)[before_rank[own]]
        _, at, which = np.unique(key, return_index=True, return_inverse=True)
        later[own, d] = at[which] != np.arange(len(own))
    # Windows in order of their start are distances in falling order.
    who, back = np.nonzero(later[:, ::-1])
    start = first[who] + distance[who] - (PLACES - 1 - back)
    new = np.concatenate(([True], (np.diff(who) != 0) | (np.diff(start) != 1)))[: len(who)]
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(who)) - 1
    return row[who[begins]], start[begins], start[ends] + 1 if len(who) else start[begins]


def _sorted_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from a partition sorted by hash, some whole groups at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def marks(some: pa.Table) -> pa.RecordBatch:
        numbers = [some.column(c).to_numpy() for c in ("doc", "row", "place")]
        found = later_windows(*numbers, some.column("context").to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["row", "first", "end"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= TOGETHER:
            every = pa.Table.from_batches(held)
            hashes = every.column("hash").to_numpy()
            cut = int(np.searchsorted(hashes, hashes[-1], "left"))  # the last group may go on
            if cut:
                yield marks(every.slice(0, cut))
                held = every.slice(cut).to_batches()
                rows -= cut
    if rows:
        yield marks(pa.Table.from_batches(held))


def _digested(digest: Callable[[bytes], bytes]):
    """A row per window of hot anchors, with its bytes and their digest."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("doc", "row", "place", "context")]
            for doc, row, place, context in zip(*columns):
                first, windows = place >> 16, place >> 8 & 255
                for j in range(windows):
                    window = context[j : j + LENGTH]
                    out.append((digest(window), window, doc, row, first + j))
            digests, found, docs, rows, starts = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(found, pa.binary()), *(pa.array(c, pa.int64()) for c in (docs, rows, starts))],
                names=["digest", "window", "doc", "row", "first"],
            )

    return scan


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without their marked bytes, described and whole."""
    for batch in batches:
        counts, spans, digests, kept_texts, removed = [], [], [], [], []
        for text, marks, digest in zip(batch.column("text"), batch.column("marks").to_pylist(), batch.column("digest").to_pylist()):
            raw, runs = text.as_py(), []
            for first, end in sorted((m["first"], m["end"] + LENGTH - 1) for m in marks or ()):
                if runs and first <= runs[-1][1]:
                    runs[-1][1] = max(end, runs[-1][1])
                else:
                    runs.append([first, end])
            edges = [0, *(x for r in runs for x in r), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) if runs else raw
            counts.append(len(raw))
            removed.append(len(raw) - len(kept))
            spans.append([{"first": a, "end": b} for a, b in runs])
            digests.append(hashlib.sha256(kept).digest() if runs else digest)
            kept_texts.append(kept)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                pa.array(digests, pa.binary()), pa.array(kept_texts, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "removed", "kept_digest", "kept"],
        )


class Repeats:
    """The repeated bytes of a corpus; ``described`` gives the documents without them."""

    def __init__(
        self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, sample: int = SAMPLE,
        digest: Callable[[bytes], bytes] = xxhash.xxh3_128_digest, buckets: int | None = None,
    ):
        self.spark, self.hot, self.sample, self.digest = docs.sparkSession, hot, sample, digest
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"),
            F.octet_length(text).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row"),
        ).withColumn("doc", F.coalesce("doc_id", F.lit(_LAST_ID))).withColumn("part", F.shiftright("row", 33))
        # A task holds one part, so it writes one file; twice as many buckets as parts keep most parts apart.
        self.buckets = buckets or min(max(2, 2 * docs.rdd.getNumPartitions()), MOST_BUCKETS)
        self.texts = bucketed(rows, self.buckets, "part", "texts")

    def _by_part(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("part", F.shiftright("row", 33)).repartition(self.buckets, "part")

    def copies(self) -> DataFrame:
        """Rows of texts that an earlier row has, marked whole."""
        rows = self.texts.where(F.col("n_bytes") >= LENGTH).select("digest", "doc", "row", "n_bytes")
        firsts = rows.groupBy("digest").agg(F.min(F.struct("doc", "row")).alias("f"), F.count("*").alias("n")).where("n > 1")
        later = rows.join(firsts, "digest").where("row <> f.row")
        return later.select("row", F.lit(0).cast("long").alias("first"), (F.col("n_bytes") - LENGTH + 1).alias("end"))

    def _crowded(self, found: DataFrame) -> DataFrame:
        """hash of the anchors that a thousandth of all places share, and more than a task should be sent."""
        n = found.count()
        rate = min(1.0, self.sample / max(1, n))
        some = found if rate == 1 else found.where(F.pmod(F.xxhash64("row", "place"), F.lit(1_000_000)) < F.lit(round(rate * 1e6)))
        # No more than a thousand anchors can have a thousandth of all places, so their list is short.
        bound = max(self.hot, n / 1000) * rate
        return scratch(some.groupBy("hash").count().where(F.col("count") > bound).select("hash"), "hot-anchors")

    def _contexts(
        self, chosen: DataFrame, run=_context, kind: str = "hash long, doc long, row long, place long, context binary"
    ) -> DataFrame:
        own = self._by_part(chosen).groupBy("part", "row").agg(F.collect_list(F.struct("hash", "place")).alias("own"))
        return (
            self.texts.select("part", "row", "doc", "text").join(own.hint("shuffle_hash"), ["part", "row"])
            .select("doc", "row", "text", "own")
            .mapInArrow(run, kind)
        )

    def marks(self) -> DataFrame:
        """row, first, end: runs of windows that equal an earlier one."""
        spark = self.spark
        copies = scratch(self.copies(), "copies")
        # Joins on (part, row) may use that the texts lie by part.
        with settings(
            spark, spark__sql__requireAllClusterKeysForCoPartition="false",
            spark__sql__sources__bucketing__autoBucketedScan__enabled="false",
        ):
            own = self.texts.where(F.col("n_bytes") >= LENGTH).select("part", "row", "text")
            later = self._by_part(copies.select("row"))
            found = scratch(
                own.join(later.hint("shuffle_hash"), ["part", "row"], "left_anti").select("row", "text")
                .mapInArrow(_find, "hash long, row long, place long"),
                "anchors",
            )
            crowded = self._crowded(found)
            any_crowded = not crowded.isEmpty()
            rest = found.join(F.broadcast(crowded), "hash", "left_anti") if any_crowded else found
            with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="65536"):
                repeated = scratch(
                    rest.repartition("hash").sortWithinPartitions("hash").select("hash", "row", "place")
                    .mapInArrow(_repeated, "hash long, row long, place long, turn long"),
                    "repeated",
                )
            # One row of each hot anchor has this turn. Spark knows the list's size and how to join it.
            hot = scratch(repeated.where(F.col("turn") == self.hot).select("hash"), "hot-anchors")
            any_hot = not hot.isEmpty()
            places = repeated.drop("turn")
            contexts = self._contexts(places.join(hot, "hash", "left_anti") if any_hot else places)
            marks = scratch(
                contexts.repartition("hash").sortWithinPartitions("hash")
                .mapInArrow(_sorted_together, "row long, first long, end long"),
                "marks",
            )
            if any_hot or any_crowded:
                many = places.join(hot, "hash", "left_semi")
                if any_crowded:
                    many = many.unionByName(found.join(F.broadcast(crowded), "hash", "left_semi"))
                marks = marks.unionByName(self._hot_marks(many))
            discard(repeated)
            discard(found)
        return marks.unionByName(copies)

    def _hot_marks(self, places: DataFrame) -> DataFrame:
        windows = scratch(
            # One worker does both steps.
            self._contexts(
                places, lambda batches, run=_digested(self.digest): run(_context(batches)),
                "digest binary, window binary, doc long, row long, first long",
            ),
            "hot-windows",
        )
        by_bytes = scratch(
            windows.groupBy("digest", "window").agg(F.min(F.struct("doc", "row", "first")).alias("f"), F.count("*").alias("n")),
            "hot-firsts",
        )
        # Written, so that the join below shuffles both sides for itself and can split what is skewed.
        by_digest = scratch(
            by_bytes.groupBy("digest").agg(F.count("*").alias("texts"), F.max("f").alias("f"), F.max("n").alias("n")), "hot-digests"
        )
        later = windows.drop("window").join(by_digest.where("texts = 1 AND n > 1").select("digest", "f"), "digest")
        clashing = by_digest.where("texts > 1").select("digest")
        if not clashing.isEmpty():
            told = by_bytes.where("n > 1").join(clashing, "digest", "left_semi").select("digest", "window", "f")
            later = later.unionByName(windows.join(told, ["digest", "window"]).drop("window"))
        later = later.where("row <> f.row OR first <> f.first")
        marks = scratch(later.select("row", "first", (F.col("first") + 1).alias("end")), "hot-marks")
        discard(windows)
        return marks

    def described(self, kept: bool = True) -> DataFrame:
        """doc_id, n_bytes, n_removed, removed (maximal runs, end exclusive), kept_digest (SHA-256), kept (bytes, if asked)."""
        marks = self.marks()
        with settings(
            self.spark, spark__sql__requireAllClusterKeysForCoPartition="false",
            spark__sql__sources__bucketing__autoBucketedScan__enabled="false",
        ):
            own = self._by_part(marks).groupBy("part", "row").agg(F.collect_list(F.struct("first", "end")).alias("marks"))
            cut = (
                self.texts.select("part", "row", "doc_id", "text", "digest")
                .join(own.hint("shuffle_hash"), ["part", "row"], "left")
                .select("doc_id", "text", "digest", "marks")
                .mapInArrow(
                    _cut,
                    "doc_id long, n_bytes long, n_removed long, removed array<struct<first:long,end:long>>, "
                    "kept_digest binary, kept binary",
                )
            )
            return scratch(cut if kept else cut.drop("kept"), "without-repeats")

    def close(self) -> None:
        """Remove the texts that were written, once what described them has been read."""
        discard_table(self.texts)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeats = Repeats(table(spark, sf_dir, "documents"))
    found = repeats.described(kept=False)
    repeats.close()
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.lower(F.hex("kept_digest")).alias("kept_sha256"),
    )
