"""Benchmark decontamination by Wu-Manber search over words.

Every window of 13 consecutive benchmark words (a shorter item is one window) is a test string. The search
slides over the words of a document and looks at one block, the two words it ends at. A shift table tells how
far the next place is at which a test string could end with that block, so most words are never looked at; where
the shift is zero, the strings filed under that suffix block and their own first block are compared word by word.

Documents are never shuffled: the windows go to every task. They are counted first and sent in blocks of at most
``WINDOWS_PER_BLOCK``; each block is one pass over the documents. With several, the documents are written once with
a row number, by which the passes are united.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. Null and empty texts have no words,
and an item without words has no window. A null ``item_id`` is listed as ``null``. Each input row
gives a row, also where a ``doc_id`` repeats or is null; ids are cast to long. Other columns, whatever their names, are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import scratch, table

WINDOW = 13
#: Bound on what one pass sends to every task, about 50 MB of Python objects.
WINDOWS_PER_BLOCK = 100_000
#: A document is contaminated when at least one word in so many is hit.
HIT_SHARE = 20

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class Searcher:
    """Wu-Manber tables of test strings that are tuples of words."""

    def __init__(self, strings: dict[tuple[bytes, ...], list[str]]):
        self.least = min(map(len, strings))
        self.block = min(2, self.least)
        self.farthest = self.least - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.files: dict[tuple, dict[tuple, list]] = {}
        for string, items in strings.items():
            for end in range(self.block, self.least + 1):
                piece = string[end - self.block : end]
                self.shift[piece] = min(self.shift.get(piece, self.farthest), self.least - end)
            suffix = string[self.least - self.block : self.least]
            self.files.setdefault(suffix, {}).setdefault(string[: self.block], []).append((list(string), items))

    def search(self, text: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """First word, word after the last, and items of each occurrence."""
        shift, files, least, farthest, one = self.shift, self.files, self.least, self.farthest, self.block == 1
        at, n = least - 1, len(text)
        while at < n:
            piece = (text[at],) if one else (text[at - 1], text[at])
            jump = shift.get(piece, farthest)
            if jump:
                at += jump
                continue
            start = at - least + 1
            for string, items in files[piece].get(tuple(text[start : start + self.block]), ()):
                if text[start : start + len(string)] == string:
                    yield start, start + len(string), items
            at += 1


def searchers(windows: list[tuple[str, list[str]]]) -> list[Searcher]:
    """One searcher for full windows and one for the shorter, whose least length would spoil the others' shifts."""
    full, short = {}, {}
    for window, items in windows:
        string = tuple(window.encode().split(b" "))
        (full if len(string) == WINDOW else short)[string] = items
    return [Searcher(strings) for strings in (full, short) if strings]


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


_HITS = "array<struct<first:int,end:int>>"
_FOUND = f"row long, doc_id long, n_words long, hits {_HITS}, items array<string>"
_ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string())),
])


def _pass(docs: DataFrame, windows: list[tuple[str, list[str]]]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = searchers(sent.value)
        for batch in batches:
            counts, hits, items = [], [], []
            for text in batch.column("text"):
                own = words(text.as_py())
                found = [x for t in tables for x in t.search(own)]
                counts.append(len(own))
                hits.append([{"first": a, "end": b} for a, b in _united([x[:2] for x in found])])
                items.append(sorted({item for x in found for item in x[2]}))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"), "doc_id": batch.column("doc_id"),
                    "n_words": counts, "hits": hits, "items": items,
                },
                schema=_ARROW,
            )

    return docs.mapInArrow(scan, _FOUND)


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Each different window, as its words with spaces between, and the items that hold it."""
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - WINDOW + 1, F.lit(1)))
    return (
        benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), own.alias("w"))
        .where(F.size("w") > 0)
        .select("item", "w", F.explode(starts).alias("at"))
        .select("item", F.array_join(F.slice("w", F.col("at"), WINDOW), " ").alias("window"))
        .groupBy("window").agg(F.collect_set("item").alias("items"))
    )


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_block: int = WINDOWS_PER_BLOCK,
) -> DataFrame:
    """doc_id, n_words, hits (maximal runs of hit words, end exclusive) and items (sorted) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    windows = benchmark_windows(benchmark)
    blocks = max(1, -(-windows.count() // per_block))
    if blocks == 1:
        return _pass(rows, [tuple(r) for r in windows.collect()]).drop("row")
    rows = scratch(rows, "decontaminate")  # every pass must see the same numbers
    dealt = windows.withColumn("block", F.pmod(F.hash("window"), F.lit(blocks)))
    passes = [
        _pass(rows, [tuple(r) for r in dealt.where(F.col("block") == k).select("window", "items").collect()])
        for k in range(blocks)
    ]
    every = passes[0]
    for one in passes[1:]:
        every = every.unionByName(one)
    together = F.sort_array(F.flatten(F.collect_list("hits")))
    merged = F.aggregate(
        "hits",
        F.array().cast(_HITS),
        lambda out, x: F.when(
            (F.size(out) > 0) & (x["first"] <= F.element_at(out, -1)["end"]),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(
                    F.element_at(out, -1)["first"].alias("first"),
                    F.greatest(F.element_at(out, -1)["end"], x["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(out, F.array(x))),
    )
    return (
        every.groupBy("row", "doc_id")
        .agg(
            F.max("n_words").alias("n_words"), together.alias("hits"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .withColumn("hits", merged)
        .drop("row")
    )


def judged(found: DataFrame) -> DataFrame:
    """``occurrences`` with n_hit and contaminated."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


ORACLE = r"""
WITH folded AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper_az, 'abcdefghijklmnopqrstuvwxyz' AS lower_az
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), upper_az, lower_az),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents, folded
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), upper_az, lower_az),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark, folded
), starts AS (
  SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS win FROM starts
), lengths AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n
), found AS (
  SELECT p.doc_id, p.i, p.n, windows.item
  FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM places) p
  JOIN windows ON windows.n = p.n AND windows.win = p.win
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
