"""Vector code compression: a codebook for each part of a vector, searched by Orchard's method.

Components become integers, floor(256 x), so every sum and every distance is exact and reruns agree. A codebook starts
as its part of the vectors with the smallest ids and is moved ``ROUNDS`` times to the means of what it was assigned.

An entry's list holds all other entries by their distance from it. The search for a part's nearest entry starts
anywhere and walks down the list of the best entry so far; when it meets a better one it jumps to that entry's list.
Entries it has met are marked and not measured again. It ends where the list goes beyond twice the distance of the
best entry, because what lies there is farther from the part than the best entry is. Ties go to the lower index.

Each round is one pass over the vectors. A task adds up what it assigns and sends one row per entry and component, so
the driver sees entries x components numbers, whatever the number of vectors; no vector is shuffled.

Dropped: null vectors, and those with null or non-finite components. Vectors shorter than the longest, or than a
multiple of the number of parts, count as ending in zeros. Integers beyond ``LARGEST`` are cut to it. Fewer vectors
than entries make a codebook of as many. Rows that repeat an id get a row each; ids are cast to long, and null ids come
last. A label's sum that exceeds a long is null. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import scratch, table
from tidemark.llm.vectors import grouped, longest, matrix

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: With up to 1,024 components a part, four times a squared distance of parts stays within 64 bits.
LARGEST = 1 << 24
TOGETHER = 4096


def integers(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are kept, and the kept rows as integers."""
    keep, values = matrix(lists, width)
    with np.errstate(over="ignore"):
        return keep, np.clip(np.floor(values[keep] * SCALE), -LARGEST, LARGEST).astype(np.int64)


class Codebooks:
    """``entries``: part, entry, component. Every part has as many entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.parts, self.size, self.components = entries.shape
        self.apart = ((entries[:, :, None] - entries[:, None]) ** 2).sum(axis=3)
        first = self.apart.copy()
        first[:, np.arange(self.size), np.arange(self.size)] = -1
        # Each entry's neighbours from near to far, without itself.
        self.lists = np.argsort(first, axis=2, kind="stable")[:, :, 1:]
        self.by_first = np.argsort(entries[:, :, 0], axis=1, kind="stable")

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance, for each row and part. All searches go on in step."""
        n = len(vectors)
        queries = vectors.reshape(n * self.parts, self.components)
        part = np.tile(np.arange(self.parts), n)
        best = np.empty(len(queries), np.int64)
        for p in range(self.parts):  # start at a neighbour in the first component
            order = self.by_first[p]
            at = np.searchsorted(self.entries[p, order, 0], queries[p :: self.parts, 0])
            best[p :: self.parts] = order[np.minimum(at, self.size - 1)]
        far = ((queries - self.entries[part, best]) ** 2).sum(axis=1)
        met = np.zeros((len(queries), self.size), bool)
        met[np.arange(len(queries)), best] = True
        at = np.zeros(len(queries), np.int64)
        live = np.arange(len(queries) if self.size > 1 else 0)
        while len(live):
            p, own = part[live], best[live]
            entry = self.lists[p, own, at[live]]
            near = self.apart[p, own, entry] <= 4 * far[live]
            live, p, own, entry = live[near], p[near], own[near], entry[near]
            at[live] += 1
            new = ~met[live, entry]
            who, p, own, entry = live[new], p[new], own[new], entry[new]
            met[who, entry] = True
            distance = ((queries[who] - self.entries[p, entry]) ** 2).sum(axis=1)
            closer = (distance < far[who]) | ((distance == far[who]) & (entry < own))
            jump = who[closer]
            best[jump], far[jump], at[jump] = entry[closer], distance[closer], 0
            live = live[at[live] < self.size - 1]
        return best.reshape(n, self.parts), far.reshape(n, self.parts)

    def written(self) -> str:
        """All components in decimal, by part, entry and position."""
        return ",".join(map(str, self.entries.ravel().tolist()))


class VectorCodes:
    """Codebooks trained on ``vectors``, and the codes of its rows."""

    def __init__(
        self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
        parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    ):
        label = F.col(label_col) if label_col else F.lit(None).cast("int")
        self.rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), label.alias("label"))
        self.parts = parts
        self.width = max(1, -(-longest(self.rows, "vector") // parts)) * parts
        self.codebooks = self._first(entries)
        for _ in range(rounds if self.codebooks else 0):
            self.codebooks = self._moved()

    def _first(self, entries: int) -> Codebooks | None:
        width = self.width

        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep, values = integers(batch.column("vector"), width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").filter(pa.array(keep)), pa.array(list(values), pa.list_(pa.int64()))],
                    names=["vec_id", "vector"],
                )

        least = (
            self.rows.select("vec_id", "vector").mapInArrow(kept, "vec_id long, vector array<long>")
            .orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
        )
        if not least:
            return None
        start = np.array([r["vector"] for r in least], np.int64).reshape(len(least), self.parts, -1)
        return Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))

    def _moved(self) -> Codebooks:
        width, codebooks = self.width, self.codebooks

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(codebooks.entries.shape, np.int64)
            counts = np.zeros(codebooks.entries.shape[:2], np.int64)
            part = np.arange(codebooks.parts)
            for batch in grouped(batches, TOGETHER):
                _, values = integers(batch.column("vector"), width)
                values = values.reshape(len(values), codebooks.parts, codebooks.components)
                codes, _ = codebooks.assign(values)
                own = np.broadcast_to(part, codes.shape)
                np.add.at(counts, (own, codes), 1)
                np.add.at(sums, (own, codes), values)
            used = np.repeat(counts.ravel(), codebooks.components)
            cell = np.arange(len(used))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[used > 0]) for x in (cell, sums.ravel(), used)], names=["cell", "total", "members"]
            )

        cells = (
            self.rows.select("vector").mapInArrow(added, "cell long, total long, members long")
            .groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members"))
            .collect()
        )
        moved = codebooks.entries.copy()
        flat = moved.reshape(-1)
        for r in cells:
            flat[r["cell"]] = int(r["total"]) // r["members"]
        return Codebooks(moved)

    def codes(self) -> DataFrame:
        """vec_id, label, code (an index per part), error of every kept row."""
        width, codebooks = self.width, self.codebooks
        kind = "vec_id long, code array<int>, error long, " + f"label {dict(self.rows.dtypes)['label']}"
        if codebooks is None:
            return self.rows.sparkSession.createDataFrame([], kind)

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in grouped(batches, TOGETHER):
                keep, values = integers(batch.column("vector"), width)
                codes, far = codebooks.assign(values.reshape(len(values), codebooks.parts, codebooks.components))
                own = pa.array(keep)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").filter(own), pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32())),
                        pa.array(far.sum(axis=1)), batch.column("label").filter(own),
                    ],
                    names=["vec_id", "code", "error", "label"],
                )

        return scratch(self.rows.mapInArrow(coded, kind), "vector-codes")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = VectorCodes(table(spark, sf_dir, "embeddings"))
    codes = trained.codes()
    of_label = codes.groupBy(F.col("label").alias("name")).agg(F.try_sum("error").alias("label_error"))
    written = trained.codebooks.written() if trained.codebooks else ""
    digits = F.transform("code", lambda i: F.lower(F.lpad(F.hex(i), 2, "0")))
    return codes.join(of_label, F.col("label").eqNullSafe(F.col("name"))).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
        F.sha2(F.lit(written), 256).alias("codebooks_sha256"),
    )


def _oracle() -> str:
    """The rounds as common table expressions: each ranks the entries of each part by distance and index."""

    def assigned(books: str) -> str:
        return f"""
  SELECT vec_id, label, part, v, entry, d FROM (
    SELECT p.vec_id, p.label, p.part, p.v, b.entry,
           list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d,
           row_number() OVER (PARTITION BY p.vec_id, p.part ORDER BY d, b.entry) AS turn
    FROM parts p JOIN {books} b USING (part)
  ) WHERE turn = 1"""

    def moved(books: str, own: str) -> str:
        return f"""
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM {books} b LEFT JOIN (
    SELECT part, entry, list(CAST(x AS BIGINT) ORDER BY i) AS v FROM (
      SELECT part, entry, i, floor(sum(v[i]) / count(*)) AS x FROM {own}, range(1, 5) r(i) GROUP BY ALL
    ) GROUP BY ALL
  ) m USING (part, entry)"""

    rounds = ",\n".join(
        f"a{r} AS ({assigned(f'b{r - 1}')}\n), b{r} AS ({moved(f'b{r - 1}', f'a{r}')}\n)" for r in range(1, ROUNDS + 1)
    )
    return rf"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * x) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, label, CAST(part AS BIGINT) AS part, v[part * 4 + 1 : part * 4 + 4] AS v FROM kept, range({PARTS}) r(part)
), b0 AS (
  SELECT part, entry, v FROM (
    SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM parts
  ) WHERE entry < {ENTRIES}
), {rounds},
last AS ({assigned(f'b{ROUNDS}')}
), coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM last GROUP BY ALL
), written AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, written
"""


ORACLE = _oracle()
