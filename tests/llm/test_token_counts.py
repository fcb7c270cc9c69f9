"""Totals against a dictionary kept by hand, commits that repeat or break off, counts against another library."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_counts as tc
from tidemark.llm.token_counts import TokenRollup
from tidemark.sources import storage

CHANGES = f"kind string, before {tc.IMAGE}, after {tc.IMAGE}"


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in rollup.totals().collect()}


def test_changes_against_a_dictionary(spark, root):
    draw = random.Random(1)
    held, want = {}, {}
    rollup = TokenRollup(spark, f"{root}/r")
    assert totals(rollup) == {}

    def some():
        return (draw.choice(["a", "b", None]), draw.choice(["en", "de", None]), draw.choice(["v1", "v2"]),
                draw.choice([0, 5, 700, None, 2**40]))

    for b in range(5):
        rows = []
        for _ in range(120):
            kind = draw.choice(["insert", "delete", "revise"]) if held else "insert"
            if kind == "insert":
                i, before, after = len(held) + 1000 * b + 1, None, some()
                while i in held:
                    i += 1
            else:
                i = draw.choice(list(held))
                before, after = held.pop(i), some() if kind == "revise" else None
            if after:
                held[i] = after
            rows.append((kind, before, after))
        changes = spark.createDataFrame(rows, CHANGES).repartition(3)
        assert rollup.commit(f"batch {b}", changes)
        assert not rollup.commit(f"batch {b}", changes)
        documents, tokens = Counter(), Counter()
        for s, g, t, n in held.values():
            documents[s, g, t] += 1
            tokens[s, g, t] += n or 0
        want = {k: (documents[k], tokens[k]) for k in documents}
        assert totals(rollup) == want
    assert rollup.commit("empty", spark.createDataFrame([], CHANGES))
    assert totals(TokenRollup(spark, f"{root}/r/")) == want


def test_a_batch_that_broke_off(spark, root):
    rollup = TokenRollup(spark, root)
    row = ("insert", None, ("a", "en", "v", 3))
    assert rollup.commit("b", spark.createDataFrame([row, row], CHANGES))
    storage.delete(spark, f"{rollup._folder('b')}/_SUCCESS")
    assert totals(rollup) == {} and not rollup.committed("b")
    assert rollup.commit("b", spark.createDataFrame([row, row], CHANGES))
    assert totals(rollup) == {("a", "en", "v"): (2, 6)}


def test_wrong_images_count_nothing(spark, root):
    one = ("a", "en", "v", 3)
    rows = [("insert", one, None), ("delete", None, one), ("other", one, one), (None, one, one)]
    rollup = TokenRollup(spark, root)
    rollup.commit("b", spark.createDataFrame(rows, CHANGES))
    assert totals(rollup) == {}


@pytest.fixture(scope="module")
def plain():
    out = {}
    for v in (tc.ENGLISH,):
        t = Tokenizer.from_file(f"{tc.TOKENIZERS}/{v}.json")
        t.encode_special_tokens = True
        out[v] = lambda text, t=t: len(t.encode(text, add_special_tokens=False).ids)
    return out


def test_counts(spark, plain):
    texts = [None, "", " ", "Hello world's  end\n\n\tok", "größe 日本 😀😀", "<|endoftext|>", "y" * 50_000, "a b " * 20_000]
    rows = [(i, t, i % 2 == 0, 5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, skip_second boolean, tokens int")
    got = tc.count_tokens(df, {"first": tc.ENGLISH, "second": tc.ENGLISH}).collect()
    for r in got:
        n = plain[tc.ENGLISH](texts[r.doc_id] or "")
        assert (r.first, r.second, r.tokens) == (n, None if r.doc_id % 2 == 0 else n, 5)
    assert tc.count_tokens(df.limit(0), {"first": tc.ENGLISH}).count() == 0


def test_query_on_its_table(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {}
    for r in docs:
        if r.lang == "en" and (r.text or "").strip():
            n, t = want.get(r.source, (0, 0))
            want[r.source] = n + 1, t + plain[tc.ENGLISH](r.text)
    got = tc.op1_token_counts(spark, sf).collect()
    assert {r.source: (r.documents, r.tokens) for r in got if r.tokenizer == tc.ENGLISH} == want
    assert {r.lang for r in got if r.tokenizer == tc.ENGLISH} == {"en"}
    other = Counter((r.source, r.lang) for r in docs if r.lang != "en" and (r.text or "").strip())
    assert {(r.source, r.lang): r.documents for r in got if r.tokenizer == tc.MULTILINGUAL} == other
