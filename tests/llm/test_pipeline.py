"""The whole pipeline against the plain versions of its stages."""

from __future__ import annotations

import corpus_pipeline
import pytest

from tests.llm.test_decontaminate import expected as contaminated
from tests.llm.test_exact_dedup import expected as exact
from tests.llm.test_mixing import key, reshared
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tidemark.llm import language


def plain_mix(docs, quality):
    size = {d: len((t or "").split()) for d, t, _ in docs}
    names = sorted({s for _, _, s in docs if s is not None}) + [None] * any(s is None for _, _, s in docs)
    total = [sum(size[d] for d, _, s in docs if s == name) for name in names]
    out = {}
    for name, words, target in zip(names, total, reshared(total)):
        whole, upto = min(int(target // words), 2) if words else 0, 0
        for d in sorted((d for d, _, s in docs if s == name), key=lambda d: (key(d, quality.get(d, 1.0)), d)):
            upto += size[d]
            extra = size[d] > 0 and upto - size[d] / 2 <= target - whole * words
            if times := min(whole + extra, 2):
                out[d] = (times, times * size[d], words)
    return out


def test_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    model = language.train(docs.select("doc_id", "text", "lang"))
    known = {r.doc_id for r in language.identify(docs, model).where("not rejected").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in known]
    kept = {r[0] for r in exact([(d, t) for d, t, _ in rows]) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    parts = plain_components({d: plain_fingerprint(t) for d, t, _ in rows})
    rows = [r for r in rows if parts[r[0]] == r[0]]
    bad = {r[0] for r in contaminated([(d, t) for d, t, _ in rows], bench) if r[4]}
    rows = [r for r in rows if r[0] not in bad]
    assert bad and len(rows) < len(known)
    want = plain_mix(rows, {r.doc_id: {1: 2.0, 0: 0.5}.get(r.quality, 1.0) for r in labels})
    got = {r.doc_id: (r.epochs, r.taken, r.source_size) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want


@pytest.fixture
def odd(spark):
    text = "the of and that there thing on er in at ed re " * 8
    rows = [
        (1, text, "en", "a", 5, "x"), (1, text, "en", "a", 5, "x"), (2, text + " ", "en", "a", 5, "x"),
        (3, None, None, None, None, None), (4, "", "en", None, 0, "x"), (None, text + "on ed", None, "b", 1, "x"),
        (5, text.replace("thing", "other", 1), "en", "b", 5, "x"), (6, "y" * 200_000, None, "b", 5, "x"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, digest string"
    )


def test_stages_on_odd_rows(spark, sf, odd):
    docs = odd
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == odd.columns
        docs = corpus_pipeline.scratch(out, "odd")
        seen.append(sorted((r.doc_id for r in docs.collect()), key=str))
    assert 3 not in seen[0] and 4 not in seen[0]
    assert seen[1].count(1) + seen[1].count(2) == 1 and 2 in seen[1]  # the longer original stays, once
    assert corpus_pipeline.mixed(spark, docs, sf).count() > 0


def test_verdicts_reach_rows_without_an_id_or_with_a_repeated_one(spark, sf):
    words = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("ae", "io", "ou", "ya")]
    text = lambda k: " ".join(words[(i * i * k + i) % 56] + str(k) for i in range(80))
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 200").first().text
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = lambda stage, rows: sorted(r.source for r in stage(spark, frame(rows), sf).collect())
    copies = [(1, text(1), "a"), (None, text(1), "b"), (2, text(1), "c"), (2, text(2), "d"),
              (None, text(3), "e"), (None, text(3), "f"), (None, text(3) + " ", "g"), (None, text(4), "h")]
    assert kept(corpus_pipeline.without_copies, copies) == ["a", "d", "g", "h"]
    near = [(1, text(1), "a"), (None, text(1), "b"), (2, text(1), "c"), (2, text(2), "d"), (None, text(3), "e"),
            (1, text(5), "f"), (5, text(5), "g")]
    assert kept(corpus_pipeline.without_near_copies, near) == ["a", "d", "e", "f"]
    bad = [(1, bench, "a"), (1, text(1), "b"), (None, bench, "c"), (None, text(2), "d")]
    assert kept(corpus_pipeline.without_benchmark, bad) == ["b", "d"]


def test_columns_called_like_row_numbers(spark, sf):
    """Only numbers the pipeline has written itself are trusted."""
    rows = [(i, "the same text of many words", "a", 7, 8) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, pipeline_row int, PIPELINE_ROW_ int")
    for stage in (corpus_pipeline.without_copies, corpus_pipeline.without_near_copies):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert [tuple(r) for r in out.collect()] == [(0, "the same text of many words", "a", 7, 8)]


def test_empty_documents(spark, sf, odd):
    docs = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0
        docs = out if name != "mix" else docs


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontaminate", "mix"]
