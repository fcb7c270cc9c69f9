"""From documents to a training mix: language, exact copies, near copies, benchmark passages, source weights.

Every stage takes the documents its predecessor kept and reads their whole texts. Decisions are made and take effect
per row, whether its ``doc_id`` is null, repeated or neither: a stage that judges rows in other tables than its input
drops them by a row number, which is written with the input (or carried from the stage before) and never computed again.
Of equal texts the longest original stays, of near copies and of equally long originals the one with the smallest id
(any id before none), and of those the first row. An empty table passes through. Columns beyond those of documents are
passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, exact_dedup, language, mixing, simhash
from tidemark.llm.common import scratch, table
from tidemark.llm.queries import prepared


def _free_name(columns: list[str]) -> str:
    name, taken = "pipeline_row", {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def _numbered(docs: DataFrame, purpose: str) -> DataFrame:
    """``docs`` written with row numbers under a name of their own, which the frame remembers."""
    name = _free_name(docs.columns)
    made = scratch(docs.withColumn(name, F.monotonically_increasing_id()), purpose)
    made._row_numbers = name
    return made


def _input(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with row numbers that stay the same however often they are read, and the numbers' name.

    Only numbers that this module has written are trusted, not a column that is called like them.
    """
    rows = docs if "_row_numbers" in vars(docs) else _numbered(docs, "numbered")
    return rows, rows._row_numbers


def _without(rows: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """Written first: numbers are few, and Spark then knows whether they fit a broadcast."""
    return rows.join(scratch(dropped.select(row), "dropped"), row, "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises."""
    prepared(spark)
    return language.recognised(docs, language.train(docs.select("doc_id", "text", "lang")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepared(spark)
    rows, row = _input(docs)
    return _without(rows, row, exact_dedup.copies(rows, row)).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    prepared(spark)
    rows, row = _input(docs)
    return _without(rows, row, simhash.near_copies(rows, row)).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of any benchmark passage to be contaminated."""
    prepared(spark)
    rows, row = _input(docs)
    found = decontaminate.judged(decontaminate.occurrences(rows, table(spark, sf_dir, "benchmark"), id_col=row))
    dropped = found.where("contaminated").select(F.col("doc_id").alias(row))
    return _without(rows, row, dropped).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as a manifest: each document that is taken, how many times, and what its source was to give."""
    prepared(spark)
    quality = mixing.label_quality(table(spark, sf_dir, "labels"))
    return mixing.mix(docs.select("doc_id", "text", "source"), quality).where("epochs > 0")


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontaminate", without_benchmark),
    ("mix", mixed),
]

#: A trained classifier and a hash over bits are beyond SQL; tests/llm/test_pipeline.py has the plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        row = vars(docs).get("_row_numbers")
        out = stage(spark, docs, sf_dir)
        if name == "mix":
            return scratch(out, f"stage-{name}")
        if row is None:
            docs = _numbered(out, f"stage-{name}")
        else:  # the stage has passed them on
            docs = scratch(out, f"stage-{name}")
            docs._row_numbers = row
    return docs
