"""Connected components by randomised contraction, one small table per round."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import scratch


def components(links: DataFrame, seed: int = 9) -> DataFrame:
    """node, root for every node of ``links`` (a, b as long); nodes of a component share their root.

    Each round maps a node to the least of itself and its neighbours and keeps the links between images. "Least"
    is by the id under an exclusive or that changes with the round, so long chains shrink by a constant share as
    well; the rounds grow with the logarithm of the largest component. Minima combine map-side, so a node with
    very many links sends one row per task. Links with a null end are ignored.
    """
    draw = random.Random(seed)
    links = scratch(links.where("a <> b").distinct(), "links")
    roots = None
    while not links.isEmpty():
        mask = draw.getrandbits(63)
        both = links.union(links.select("b", "a"))
        least = F.least(F.min(F.col("b").bitwiseXOR(F.lit(mask))), F.col("a").bitwiseXOR(F.lit(mask)))
        image = scratch(
            both.groupBy("a").agg(least.alias("m"))
            .select(F.col("a").alias("node"), F.col("m").bitwiseXOR(F.lit(mask)).alias("image")),
            "images",
        )
        if roots is None:
            roots = image.select("node", F.col("image").alias("root"))
        else:
            step = image.select(F.col("node").alias("root"), F.col("image").alias("next"))
            roots = roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        roots = scratch(roots, "roots")
        links = scratch(
            links.join(image.select(F.col("node").alias("a"), F.col("image").alias("x")), "a")
            .join(image.select(F.col("node").alias("b"), F.col("image").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    return roots if roots is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root"))
