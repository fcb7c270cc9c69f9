"""Token counts as delta-maintained rollups by source, language and tokenizer version.

The rollup is a folder of batches. A batch of changes is first reduced to signed sums per key: an insert adds what a
document now is, a delete subtracts what it was, a revision does both, so that a recount, a move to another source or a new
tokenizer version is one change. The reduction combines map-side, so a batch leaves a row per key, however large.

A batch is committed by Spark's own job commit: its ``_SUCCESS`` file makes it visible. A batch whose id is committed
is not applied again; one that broke off is invisible, and is written anew by the retry. Totals are the sum of the committed
batches, so a document's tokens are never read again. One writer per batch id at a time.

Null sources, languages and versions are keys; null token counts are zero. A change without the image its kind needs
counts nothing for it. Keys whose documents and tokens both came to zero are not in the totals. Ids are not looked at: whoever feeds
changes says what a document was.

Tokenizers are public vocabularies read from ``folder`` by the driver and sent to the tasks; a vocabulary has a fixed
size. Texts are encoded whole; special tokens in a text are ordinary text; null text has no tokens. Columns that are not
named as source, language, tokenizer or text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import folder as new_folder, scratch, table
from tidemark.sources import storage

TOKENIZERS = "/opt/tokenizers"
#: Fixed by the vocabularies: what splits a text before their merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ENGLISH, MULTILINGUAL = "byte_bpe_50k", "byte_bpe_multi_50k"

KEY = ("source", "lang", "tokenizer")
IMAGE = "struct<source:string,lang:string,tokenizer:string,tokens:long>"


def count_tokens(docs: DataFrame, versions: dict[str, str], folder: str = TOKENIZERS) -> DataFrame:
    """``docs`` with a count for each of ``versions``: new column, to the vocabulary it counts with.

    A row's column is null where a boolean column of ``docs`` named ``skip_<column>`` holds.
    """
    files = {v: (Path(folder) / f"{v}.tiktoken").read_bytes() for v in set(versions.values())}
    sent = docs.sparkSession.sparkContext.broadcast(files)
    passed = [c for c in docs.columns if c != "text" and not c.startswith("skip_")]
    skips = {c: f"skip_{c}" for c in versions if f"skip_{c}" in docs.columns}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = {}
        for v, raw in sent.value.items():
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
            encode[v] = tiktoken.Encoding(v, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = [batch.column(c) for c in passed]
            for column, v in versions.items():
                skip = batch.column(skips[column]).to_pylist() if column in skips else [False] * len(texts)
                out.append(pa.array([None if s else len(encode[v](t or "")) for t, s in zip(texts, skip)], pa.int64()))
            yield pa.RecordBatch.from_arrays(out, names=[*passed, *versions])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in passed] + [f"`{c}` long" for c in versions])
    return docs.mapInArrow(scan, schema)


def image(source: Column, lang: Column, tokenizer: Column, tokens: Column) -> Column:
    return F.struct(
        source.alias("source"), lang.alias("lang"), tokenizer.alias("tokenizer"), tokens.cast("long").alias("tokens")
    ).cast(IMAGE)


def no_image() -> Column:
    return F.lit(None).cast(IMAGE)


def deltas(changes: DataFrame) -> DataFrame:
    """Signed documents and tokens per key of changes (kind: insert, delete or revise; before and after images)."""
    added = F.when(F.col("kind").isin("insert", "revise"), F.col("after"))
    removed = F.when(F.col("kind").isin("delete", "revise"), F.col("before"))
    signed = F.explode(F.array(F.struct(F.lit(1).alias("sign"), added.alias("i")), F.struct(F.lit(-1).alias("sign"), removed.alias("i"))))
    return (
        changes.select(signed.alias("c")).where("c.i IS NOT NULL")
        .groupBy(*[F.col(f"c.i.{k}").alias(k) for k in KEY])
        .agg(
            F.sum(F.col("c.sign").cast("long")).alias("documents"),
            F.sum(F.col("c.sign") * F.coalesce("c.i.tokens", F.lit(0))).alias("tokens"),
        )
    )


class TokenRollup:
    """Additive totals under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, batch_id: str) -> str:
        return f"{self.root}/{hashlib.sha256(batch_id.encode()).hexdigest()[:32]}"

    def committed(self, batch_id: str) -> bool:
        return storage.exists(self.spark, f"{self._folder(batch_id)}/_SUCCESS")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if it had been applied."""
        if self.committed(batch_id):
            return False
        # A row per key: one file does, and nothing is left of a try that broke off.
        deltas(changes).coalesce(1).write.mode("overwrite").parquet(self._folder(batch_id))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens."""
        done = [
            f"{self.root}/{name}" for name in storage.names(self.spark, self.root)
            if storage.exists(self.spark, f"{self.root}/{name}/_SUCCESS")
        ]
        schema = "source string, lang string, tokenizer string, documents long, tokens long"
        rows = self.spark.read.schema(schema).parquet(*done) if done else self.spark.createDataFrame([], schema)
        return (
            rows.groupBy(*KEY).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
            .where("documents <> 0 OR tokens <> 0")
        )


def op1_token_counts(spark: SparkSession, sf_dir: str, folder: str = TOKENIZERS) -> DataFrame:
    """All documents through three batches, the first replayed.

    ``load`` inserts every document with its count by the English vocabulary; ``recount`` revises those of any other or
    no language to the multilingual one; ``blank`` deletes documents without a word, under the version they then have.
    """
    foreign = ~F.col("lang").eqNullSafe("en")
    counted = scratch(
        count_tokens(
            table(spark, sf_dir, "documents").select(
                "text", "source", "lang", (~foreign).alias("skip_multilingual"),
                F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True)).alias("blank"),
            ),
            {"english": ENGLISH, "multilingual": MULTILINGUAL}, folder,
        ),
        "token-counts",
    )
    first = image(F.col("source"), F.col("lang"), F.lit(ENGLISH), F.col("english"))
    second = image(F.col("source"), F.col("lang"), F.lit(MULTILINGUAL), F.col("multilingual"))

    def batch(kind: str, before: Column, after: Column, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), before.alias("before"), after.alias("after"))

    load = batch("insert", no_image(), first, counted)
    rollup = TokenRollup(spark, new_folder(spark, "token-rollup"))
    rollup.commit("load", load)
    rollup.commit("recount", batch("revise", first, second, counted.where(foreign)))
    rollup.commit("load", load)
    rollup.commit("blank", batch("delete", F.when(foreign, second).otherwise(first), no_image(), counted.where("blank")))
    return rollup.totals()
