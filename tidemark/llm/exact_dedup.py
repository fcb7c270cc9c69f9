"""Exact dedup by skew-safe combining.

Texts are equal when they agree after all white space is deleted. Copies are combined three times, and the
whole normalised text is a grouping key each time, so equal digests are never taken for equal texts:

1. locally: Spark's partial aggregation keeps one row per text and task;
2. per salt: the survivors of a text meet in one of ``salts`` groups, chosen by the task they come from, so a
   text that a third of all rows share sends one row per task and no group gets more than a share of them;
3. globally: the winners of the salts, at most ``salts`` rows per text.

Documents then learn their group by digest alone, which carries no text. That is sound because the third step
has counted the different texts of each digest; if a digest ever has several, its documents are matched by text.

Null text counts as empty. Rows that repeat a ``doc_id`` count as copies of each other if their texts are equal; of those
that carry the winning length and id the first row is kept. A null id loses against any other of the same length. Ids are
cast to long. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import WHITE, hex_lower, scratch, sha256, table

SALTS = 16
#: A winner is one number, so that combining stays a hash aggregation: length first, then the smaller id.
_SHIFT = Decimal(2**65)
_LAST = Decimal(2**63)


def _winner(chars: Column, doc_id: Column) -> Column:
    """A decimal that is largest for the longest text and, among those, the smallest id."""
    preference = F.when(doc_id.isNull(), F.lit(0).cast("decimal(20,0)")).otherwise(
        F.lit(_LAST) - doc_id.cast("decimal(19,0)")
    )
    length = chars.cast("decimal(10,0)") * F.lit(_SHIFT)
    return (length + preference).cast("decimal(38,0)")


def _winner_id(best: Column) -> Column:
    rest = best % F.lit(_SHIFT)
    return F.when(rest > 0, (F.lit(_LAST) - rest).cast("long"))


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WHITE}+", "")


def _members(
    docs: DataFrame, carried: list[str], id_col: str, text_col: str, salts: int, digest: Callable[[Column], Column]
) -> DataFrame:
    """One row per input row: carried columns, doc_id, chars, copies and best of its group, which is (digest, norm).

    ``norm`` is null unless different texts share the digest.
    """
    rows = docs.select(
        *carried,
        F.col(id_col).cast("long").alias("doc_id"),
        normalised(F.col(text_col)).alias("norm"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"),
    ).withColumn("digest", digest(F.col("norm")))

    salted = (
        rows.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "norm")
        .agg(F.count("*").alias("copies"), F.max(_winner(F.col("chars"), F.col("doc_id"))).alias("best"))
    )
    # Dealt by digest only, so the next two groupings need no shuffle of their own.
    texts = (
        salted.repartition("digest")
        .groupBy("digest", "norm")
        .agg(F.sum("copies").alias("copies"), F.max("best").alias("best"))
    )
    groups = scratch(
        texts.groupBy("digest").agg(
            F.count("*").alias("texts"), F.max("copies").alias("copies"), F.max("best").alias("best")
        ),
        "exact-groups",
    )
    own = [*carried, "doc_id", "chars", "digest"]
    members = rows.select(*own, F.lit(None).cast("string").alias("norm")).join(
        groups.where("texts = 1").select("digest", "copies", "best"), "digest"
    )
    clashing = groups.where("texts > 1").select("digest")
    if not clashing.isEmpty():
        members = members.unionByName(
            rows.join(clashing, "digest", "left_semi").select(*own, "norm")
            .join(texts.join(clashing, "digest", "left_semi"), ["digest", "norm"])
            .select(*own, "norm", "copies", "best")
        )
    return members


def copies(
    docs: DataFrame,
    row_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """``row_col`` of all rows but one of each group. Of rows with the winning length and id, the least number stays."""
    several = scratch(
        _members(docs, [row_col], id_col, text_col, salts, digest).where("copies > 1")
        .select(row_col, "digest", "norm", _wins().alias("wins")),
        "copies",
    )
    return several.join(_kept_rows(several, row_col), row_col, "left_anti").select(row_col)


def _wins() -> Column:
    return _winner(F.col("chars"), F.col("doc_id")) == F.col("best")


def _kept_rows(several: DataFrame, row_col: str) -> DataFrame:
    return several.where("wins").groupBy("digest", "norm").agg(F.min(row_col).alias(row_col)).select(row_col)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    members = scratch(
        _members(rows, ["row"], "id", "text", salts, digest)
        .select("row", "doc_id", "digest", "norm", "copies", "best", _wins().alias("wins")),
        "exact-members",
    )
    # Only rows that may have to be told from equals take part.
    kept = _kept_rows(members.where("copies > 1"), "row").withColumn("chosen", F.lit(True))
    return members.join(kept, "row", "left").select(
        "doc_id",
        _winner_id(F.col("best")).alias("keep_id"),
        F.col("copies").alias("group_size"),
        ((F.col("copies") == 1) | F.coalesce("chosen", F.lit(False))).alias("kept"),
        "digest",
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", hex_lower(F.col("digest")).alias("text_sha256")
    )


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""
