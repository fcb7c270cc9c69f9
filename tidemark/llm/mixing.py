"""Mixing sources to target weights with Efraimidis-Spirakis sampling, in DataFrame operations only.

Targets: sources share ``share`` of all words by weight, none beyond ``most`` times its own size; what a source
cannot take is shared again by weight among the others until none is above. In closed form that is a water level:
with sources in order of cap over weight, the level is what is left for the rest divided by their weights, at the
first source whose cap is not reached (further on the same quotient only falls, so it is the largest such).

A source takes as many complete epochs as its target holds; the remainder is a weighted sample without replacement.
Every document draws ``-ln(u) / quality`` with u hashed from its id and the seed, so reruns agree and a document
with twice the quality is drawn twice as likely. Documents are sorted by that key within their source and their
sizes are summed up in that order; the sample is the documents before the remainder is used up, the one that
crosses it included when that comes nearer.

No source is sorted in one task. The rows (id, source number, size, key; no text) are range-partitioned by source and
key and written with their partition's number (only the sums, a row per source, are ranked in one task); sums within a partition plus the sums of the source's partitions before
it give each row its place. A source with a third of all rows spreads over a third of the partitions.

Null text has no words and is never drawn for a fraction, but counts in complete epochs. A null source is a
source, ordered last; a null, zero or negative quality counts as ``LOW``. Rows that repeat an id are documents of
their own: they draw the same key and are placed next to each other. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import partitions, scratch, table

#: Weights of the sources in order of their name, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = 3
#: Quality weights: of documents labelled good, bad, and not labelled.
GOOD, BAD, UNLABELLED = 2.0, 0.5, 1.0
LOW = 1e-6
_BITS = 48


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS
) -> DataFrame:
    """``sizes`` has source, source_size and documents, a row per source; adds number (by name) and target."""
    everywhere = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    level = (F.col("budget") - F.col("capped_before")) / F.col("weight_rest")
    return (
        sizes.withColumn("number", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("budget", F.sum("source_size").over(everywhere) * F.lit(share))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_rest", F.sum("weight").over(rest))
        .withColumn("level", F.max(F.when(level * F.col("weight") < F.col("cap"), level)).over(everywhere))
        .withColumn(
            "target",
            F.when(F.col("level").isNull(), F.col("cap"))
            .otherwise(F.least("cap", F.col("level") * F.col("weight"))),
        )
        .select("source", "source_size", "number", "target")
    )


def drawn_key(doc_id: Column, quality: Column, seed: int = SEED) -> Column:
    """Exponential with the quality as its rate, from 48 hashed bits."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    u = (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(float(1 << _BITS))
    return -F.log(u) / F.greatest(F.coalesce(quality, F.lit(LOW)), F.lit(LOW))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs (times the document is taken), taken.

    ``docs`` has doc_id, text and source. ``quality`` has doc_id and quality; other documents get ``UNLABELLED``.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    if quality is None:
        rows = rows.withColumn("quality", F.lit(UNLABELLED))
    else:
        own = quality.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        rows = rows.join(own, "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(UNLABELLED)))
    rows = scratch(
        rows.select("doc_id", "source", "size", drawn_key(F.col("doc_id"), F.col("quality"), seed).alias("key")),
        "mix-rows",
    )
    sources = scratch(
        targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets"
    )
    named = rows.join(
        sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
    ).drop("name")
    order = ["number", "key", "doc_id"]
    # Written, so that a row's partition is a fact of the data and not of one run of the sort.
    dealt = scratch(
        named.repartitionByRange(4 * partitions(spark), *order).withColumn("part", F.spark_partition_id()), "mix-dealt"
    )
    parts = dealt.groupBy("number", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = scratch(
        parts.select("number", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before")),
        "mix-parts",
    )
    in_part = Window.partitionBy("number", "part").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.join(parts, ["number", "part"]).withColumn(
        "upto", F.col("words_before") + F.sum("size").over(in_part)
    )
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most)))
    whole = F.coalesce(whole, F.lit(0)).cast("long")
    rest = F.col("target") - whole * F.col("source_size")
    # Half of a document on either side: the nearer of taking and leaving the one that crosses.
    extra = (F.col("size") > 0) & (F.col("upto") - F.col("size") / 2 <= rest)
    epochs = F.least(whole + extra.cast("long"), F.lit(most).cast("long"))
    return (
        placed.withColumn("epochs", epochs)
        .select("doc_id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size")).alias("taken"))
    )


def label_quality(labels: DataFrame) -> DataFrame:
    """Quality weights of labelled documents."""
    good = F.when(F.col("quality") == 1, GOOD).when(F.col("quality") == 0, BAD).otherwise(UNLABELLED)
    return labels.select("doc_id", good.alias("quality"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, label_quality(table(spark, sf_dir, "labels"))).drop("source", "epochs")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5 ELSE 1.0 END) AS quality
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1
), d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5('3:' || doc_id), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE)
           / coalesce(quality, 1.0::DOUBLE) AS k
  FROM documents LEFT JOIN w USING (doc_id)
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM d GROUP BY 1
), c AS (
  SELECT *, ([3.0, 1.0, 2.0])[number % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget
  FROM s
), l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, number
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, number
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
  FROM c
), t AS (
  SELECT source, source_size, least(cap, weight * max(CASE WHEN own_level * weight < cap THEN own_level END) OVER ())
                                AS target
  FROM l
), p AS (
  SELECT d.doc_id, size, source_size, target,
         least(floor(target / source_size), 2) AS whole,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(whole + CASE WHEN size > 0 AND upto - size / 2.0::DOUBLE <= target - whole * source_size
                               THEN 1 ELSE 0 END, 2) * size AS BIGINT) AS taken
FROM p
"""
