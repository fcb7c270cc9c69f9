"""Target-distribution importance resampling over hashed word runs.

A text's bytes go through one table that lower-cases A-Z and blanks separators, and are split into words. Features are
all runs of one to three words; the CRC-32 of a run, continued over a blank and the next word, is that of the longer
run, so no run is ever put together. A feature falls into the bucket of its CRC-32 modulo ``BUCKETS``.

Every task reduces the texts it has read to one Counter of buckets, and Spark adds those up for the raw documents and for the target.
The logarithm of the two smoothed frequencies' quotient is a bucket's gain, a document's weight the sum over its
features. Gumbel noise from a hash of the id makes the highest scores a draw without replacement in proportion to the
weights' exponentials. Documents are ranked by a range partitioning with the sizes of the partitions before, in no
single task. The driver sees one number per bucket, whatever the number of documents.

Null and empty texts have no features: their weight is 0 and they are never drawn. Whole texts are read, in pieces of
``_PIECE`` bytes cut at blanks. A null doc_id is hashed like an empty one and comes after others of the same score; rows
that repeat an id get a row each, in the order of their weights and then as stored. Ids are cast to long. Without
target texts every gain follows from the raw counts alone. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import partitions, scratch, table

BUCKETS = 10_000
WORDS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEPT or c >= 128 else 32 for c in range(256))
_PIECE = 1 << 20


def _pieces(folded: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(folded):
        end = len(folded)
        if end - at > _PIECE:
            end = folded.rfind(b" ", at, at + _PIECE)
            if end <= at:
                end = folded.find(b" ", at + _PIECE)
                end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end + 1


def hashed(text: bytes | None) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and the buckets of the features that end in them, a piece of the text at a time."""
    # What the runs that ended so far, of one word, of two and so on, pass on to the next word as their seed.
    ended: list[list[int]] = [[] for _ in range(WORDS - 1)]
    for words in _pieces(text.translate(_FOLD)) if text else ():
        if not words:
            continue
        runs = list(map(crc32, words))
        found = list(runs)
        for length in range(WORDS - 1):
            seeds = ended[length] + list(map(crc32, repeat(b" "), runs))
            ended[length] = seeds[-1:]
            seeds.pop()
            runs = list(map(crc32, words[len(words) - len(seeds) :], seeds))
            found += runs
            if not runs:
                break
        yield len(words), np.array(found, np.int64) % BUCKETS


def bucket_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                for _, buckets in hashed(text.as_py()):
                    counter.update(buckets.tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counter), pa.int64()), pa.array(list(counter.values()), pa.int64())], names=["bucket", "n"]
        )

    own = texts.select(F.col(text_col).cast("binary").alias("text"))
    return own.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """A bucket's gain in thousandths of a nat, rounded down."""
    s_all, t_all = float(sum(raw.values()) + BUCKETS), float(sum(target.values()) + BUCKETS)
    quotients = (
        float(target.get(b, 0) + 1) * s_all / (float(raw.get(b, 0) + 1) * t_all) for b in range(BUCKETS)
    )
    return np.array([math.floor(1000 * math.log(q)) for q in quotients], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, n_words, n_features, weight of every row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((batch.num_rows, 3), np.int64)
            for own, text in zip(sums, batch.column("text")):
                for words, buckets in hashed(text.as_py()):
                    own += (words, len(buckets), gain[buckets].sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), *map(pa.array, sums.T.copy())],
                names=["doc_id", "row", "n_words", "n_features", "weight"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.col(text_col).cast("binary").alias("text"),
    )
    return rows.mapInArrow(weigh, "doc_id long, row long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32)))))


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (from 1; null if the document is not drawn) of every row."""
    spark = docs.sparkSession
    raw, wanted = (
        {r["bucket"]: r["n"] for r in bucket_counts(df, col).collect()} for df, col in ((docs, text_col), (target, target_col))
    )
    scored = scratch(
        weighed(docs, gains(raw, wanted), id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)),
        "importance",
    )
    long_enough = F.col("n_words") >= least_words
    order = [long_enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), "row"]
    # Written, so that a row's place is a fact of the data and not of one run of the sort.
    sorted_rows = scratch(
        scored.repartitionByRange(2 * partitions(spark), *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "importance-order",
    )
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        sorted_rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.count_if(long_enough).alias("long_enough"))
        .select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
                F.floor(F.sum("long_enough").over(Window.partitionBy()) * percent / 100).alias("draws"))
    )
    rank = F.col("before") + place + 1
    return sorted_rows.withColumn("part", part).join(F.broadcast(scratch(parts, "importance-parts")), "part").select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(rank <= F.col("draws"), rank).alias("rank")
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
