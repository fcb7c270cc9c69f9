"""Held-out accuracy, scores against a loop over subwords, rejection."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    return docs, language.train(docs)


def plain_logits(model, text):
    raw = bytes(language.folded(text))
    total, n_all = np.zeros(len(model.languages)), 0
    for i in range(len(raw)):
        for n in (2, 3, 4):
            gram = raw[i : i + n]
            if len(gram) < n or 32 in gram[1:-1] or gram == b"  ":
                continue
            h, is_one = language._buckets(np.frombuffer(gram, np.uint8), n)
            assert is_one[0]
            total += model.scores[h[0], : len(model.languages)]
            n_all += 1
    return total / max(1, n_all) + model.bias


def test_held_out_accuracy(trained):
    docs, model = trained
    found = language.identify(docs, model)
    rows = found.join(docs, "doc_id").where(language.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = rows.collect()
    assert len(rows) > 250
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.98
    assert sum(r.rejected for r in rows) / len(rows) <= 0.02
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_is_the_crc(spark):
    ids = spark.range(50).withColumnRenamed("id", "doc_id")
    got = ids.select("doc_id", language.held_out(ids["doc_id"]).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_scores_over_whole_texts(trained):
    _, model = trained
    draw = random.Random(1)
    texts = ["a", "Ä", "the  house. 12 und", "x" * 9, "é b"] + [
        " ".join("".join(draw.choices("abcéñß, ", k=draw.randint(1, 9))) for _ in range(40)) for _ in range(20)
    ]
    got = model.logits(texts)
    for t, row in zip(texts, got):
        assert np.allclose(row, plain_logits(model, t), atol=1e-4)


def test_long_texts_are_added_up_in_pieces(trained, monkeypatch):
    _, model = trained
    text = " ".join(random.Random(2).choices(["der", "die", "und", "schön", "le", "été"], k=9000))
    whole = model.logits([text, "kurz", text])
    k = len(model.languages)
    small = language.Model(model.languages * 100, np.tile(model.scores[:, :k], 200), np.tile(model.bias, 100))
    pieces = small.logits([text, "kurz", text])[:, :k]
    assert len(text.encode()) > (1 << 23) // small.scores.shape[1]
    assert np.allclose(whole, pieces, atol=1e-4)
    a, b = language.counts(text), language.counts(text + " " + text)
    assert a.sum() * 2 == b.sum()


def test_rejection_and_nulls(trained, spark):
    docs, model = trained
    draw = random.Random(3)
    strange = " ".join("".join(draw.choices("бвгджзклмнпрст", k=6)) for _ in range(80))
    rows = [(1, None, "x"), (2, "", "x"), (3, " 12 !? 5²", "x"), (4, strange, "x"), (None, "the of and that there", "x"), (5, "日本語", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert len(got) == 6
    for i in (1, 2, 3):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[4].rejected and got[4].lang_pred in model.languages
    assert got[5].lang_pred in model.languages
    assert (got[None].lang_pred, got[None].rejected) == ("en", False)
    assert language.identify(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = language.train(df)
    assert [r.lang_pred for r in language.identify(df, language.train(df.limit(0))).collect()] == ["und", "und"]
    assert {r.lang_pred for r in language.identify(df, model).collect()} <= {"und", "en"}


def test_training_is_repeatable_and_never_sees_held_out_rows(spark, trained):
    docs, model = trained
    again = language.train(docs)
    assert np.array_equal(model.scores, again.scores) and model.threshold == again.threshold
    spoilt = docs.withColumn("lang", F.when(language.held_out(docs["doc_id"]), "zz").otherwise(docs["lang"]))
    assert "zz" not in language.train(spoilt).languages


def test_null_and_repeated_ids_are_sampled_by_their_texts(spark, trained):
    """Without ids, and with one text in most rows, every language is learned and no more rows than allowed are taken."""
    docs, _ = trained
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    taken = []
    fit = language.fit
    try:
        language.fit = lambda rows: taken.append(rows) or fit(rows)
        model = language.train(nameless, sample=200)
        copies = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text again").alias("text"), F.lit("en").alias("lang"))
        again = language.train(nameless.union(copies).repartition(5), sample=200)
    finally:
        language.fit = fit
    assert model.languages == again.languages == ["de", "en", "es", "fr"]
    for rows in taken:
        assert len(rows) == 200 and all(sum(r[0] == name for r in rows) == 50 for name in model.languages)


@pytest.mark.parametrize("left_out", ["en", "de"])
def test_texts_of_a_language_left_out_are_rejected(spark, left_out):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = language.train(docs.where(F.col("lang") != left_out), sample=1600)
    some = docs.where(language.held_out(F.col("doc_id")) & (F.pmod("doc_id", F.lit(4)) == 0))
    found = language.identify(some, model).join(some.select("doc_id", "lang"), "doc_id").groupBy("lang").agg(
        F.avg(F.col("rejected").cast("int")).alias("share")
    )
    share = {r["lang"]: r["share"] for r in found.collect()}
    assert share.pop(left_out) >= 0.9
    assert max(share.values()) <= 0.05  # some texts mix two languages, one of which is now unknown


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.train(empty)
    assert language.identify(empty, model).count() == 0 and language.recognised(empty, model).count() == 0
