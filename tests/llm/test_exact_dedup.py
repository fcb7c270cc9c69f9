"""Groups against a dictionary of normalised texts, with a digest that clashes as well."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup
from tidemark.llm.common import sha256


def expected(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out, taken = [], set()
    for i, t in docs:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        own = groups[norm]
        keep = min(own)[2]
        out.append((i, keep, len(own), (-len(t or ""), i) == (min(own)[0], keep) and norm not in taken))
        taken |= {norm} if out[-1][3] else set()
    return sorted(out, key=str)


def corpus():
    draw = random.Random(1)
    base = ["", "ab cd", "ABcd", "a b", "日本 語", "x" * 40_000, "é" * 9, "é" * 9, "𝒳 𝒴"]
    docs = [(i, "hot text here") for i in range(400)]
    for i in range(400, 700):
        t = draw.choice(base)
        docs.append((i, "".join(c + draw.choice(["", " ", "\n", "\t\r", "\x0b"]) for c in t[:30]) + t[30:]))
    docs += [(None, None), (None, "hot  text   here   "), (-5, "only negative"), (-7, "only negative"), (2**62, "abcd")]
    docs += [(800, "twice"), (800, "twice"), (801, " \t"), (900, "longer  one"), (900, "longer one"), (901, "long" * 300_000)]
    docs += [(None, "nameless")] * 40
    return docs


@pytest.mark.parametrize("digest", [sha256, lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1)), lambda t: F.lit(b"0")])
def test_groups(spark, digest):
    docs = corpus()
    df = spark.createDataFrame([(*d, "n", 1, 5) for d in docs], "doc_id long, text string, norm string, best int, row int")
    got = exact_dedup.exact_groups(df.repartition(7), digest=digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == expected(docs)
    assert sum(r.kept for r in got) == len({r.digest for r in got}) or digest is not sha256


def test_empty(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
