"""Changes of a keyed table as rows: what each version inserted, updated and deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.lookup import KEY

#: The column that makes a row a change, and what it can say.
KIND = "row_kind"
INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"


def _number_of(version: Column, numbers: dict[int, int | None]) -> Column:
    pairs = [F.lit(x).cast("bigint") for own, other in numbers.items() if other is not None for x in (own, other)]
    return F.create_map(*pairs)[version] if pairs else F.lit(None).cast("bigint")


def changelog(rows: DataFrame, versions: list[int], key: str = KEY) -> DataFrame:
    """version, row_kind, ``key`` and the other columns: how each of ``versions`` differs from the one before it.

    ``rows`` has every row of every version, with its ``version``. The first version listed is the beginning, so all of its
    rows are inserts. An update is two rows, the old one and the new one. Rows that stayed the same make none. One
    shuffle by key, in which a key has a row per version; nothing is joined.
    """
    versions = sorted(versions)
    rest = [c for c in rows.columns if c not in (key, "version")]
    along = Window.partitionBy(key).orderBy("version")
    before = dict(zip(versions, [None, *versions[:-1]]))
    after = dict(zip(versions, [*versions[1:], None]))
    seen = rows.where(F.col("version").isin(versions)).select(key, "version", F.struct(*rest).alias("new"))
    seen = seen.select(
        "*", F.lag("new").over(along).alias("old"),
        F.lag("version").over(along).eqNullSafe(_number_of(F.col("version"), before)).alias("follows"),
        F.lead("version").over(along).alias("next"), _number_of(F.col("version"), after).alias("successor"),
    )
    inserted = ~F.col("follows") | F.col("old").isNull()
    updated = ~inserted & ~F.col("old").eqNullSafe(F.col("new"))
    gone = F.col("successor").isNotNull() & ~F.col("next").eqNullSafe(F.col("successor"))

    def change(when: Column, version: str, kind: str, row: str) -> Column:
        return F.when(when, F.struct(F.col(version).alias("version"), F.lit(kind).alias(KIND), F.col(row).alias("row")))

    changes = F.array_compact(F.array(
        change(inserted, "version", INSERT, "new"), change(updated, "version", BEFORE, "old"),
        change(updated, "version", AFTER, "new"), change(gone, "successor", DELETE, "new"),
    ))
    found = seen.select(key, F.explode(changes).alias("change"))
    return found.select("change.version", f"change.{KIND}", key, "change.row.*")


def replayed(changes: DataFrame, key: str = KEY) -> DataFrame:
    """The table that ``changes`` lead to; combines map-side."""
    rest = [c for c in changes.columns if c not in (key, "version", KIND)]
    # A version touches a key once: the old half of an update says nothing that the new half does not.
    last = changes.where(F.col(KIND) != BEFORE).groupBy(key).agg(F.max_by(F.struct(KIND, *rest), "version").alias("last"))
    return last.where(F.col(f"last.{KIND}") != DELETE).select(key, *[f"last.{c}" for c in rest])


def insert_only(changes: DataFrame) -> DataFrame:
    """The rows of a changelog for a table that can only be appended to; any other change fails the job that meets it."""
    refused = F.raise_error(F.concat(F.lit("an append-only table cannot take the change "), F.col(KIND)))
    return changes.where(F.when(F.col(KIND) == INSERT, True).otherwise(refused.cast("boolean"))).drop(KIND)
