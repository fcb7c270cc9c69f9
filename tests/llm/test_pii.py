"""Base spans against the contract's patterns in Python, discovery against a plain bootstrap."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


RUN = r"[\p{L}\p{M}\p{N}_]"


def tokenised(text):
    return regex.findall(rf"{RUN}+|[^ \t\n\x0b\f\r\p{{L}}\p{{M}}\p{{N}}_]", text)


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def holds(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 9 <= len(d) <= 15


def plain(text):
    return {
        kind: [m.span() for m in re.finditer(p, text) if holds(kind, m[0])] for kind, p in PLAIN.items()
    }


def corpus(seed):
    draw = random.Random(seed)
    some = lambda alphabet, a, b: "".join(draw.choices(alphabet, k=draw.randint(a, b)))
    pieces = [
        lambda: some("ab.1_%+-@", 1, 14) + "@" + some("ab-1.", 1, 8) + some(".co", 1, 4),
        lambda: ".".join(some("0123456789", 1, 3) for _ in range(draw.randint(2, 9))),
        lambda: draw.choice(["", "0", "00"]) + ".".join(str(draw.randint(0, 300)) for _ in range(4)),
        lambda: draw.choice(["", " ", "-"]).join(some("0123456789", 4, 4) for _ in range(draw.randint(2, 6))),
        lambda: draw.choice(["4111 1111 1111 1111", "378282246310005", "4111-1111-1111-1112", "6304000000000000000"]),
        lambda: "+" + some("0123456789 ().-", 1, 20),
        lambda: draw.choice(["größe", "日本", "𝒳", "\n", "+", "@", "word", "x", "  "]),
    ]
    texts = ["".join(draw.choice(pieces)() + draw.choice(["", " ", ",", "_"]) for _ in range(draw.randint(0, 14)))
             for _ in range(250)]
    return texts + ["", "1" * 3000, "a" * 3000, "1-" * 3000, "+1" + "(" * 5000, "a." * 1500 + "@b.c_d@e.f",
                    "1." * 3000, "a@" * 3000, "a@b.c" * 500]


@pytest.mark.parametrize("seed", range(3))
def test_base_spans(spark, seed):
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in df.select("i", *[c.alias(k) for k, c in pii.base_spans(F.col("text")).items()]).collect():
        want = plain(texts[r.i])
        for kind in pii.KINDS:
            got = [(p["start"], p["end"]) for p in r[kind]]
            assert got == want[kind], (kind, texts[r.i][:200])


def test_very_long_runs(spark):
    texts = ["1" * 300_000, "a" * 300_000, "1-" * 100_000, "+1" + "(" * 100_000, "a@" * 100_000, "1." * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r for r in df.select("i", *[F.size(c).alias(k) for k, c in pii.base_spans(F.col("text")).items()]).collect()}
    assert [sum(got[i][k] for k in pii.KINDS) for i in range(6)] == [0, 0, 0, 0, 0, 12_500]


def mentions_of(text):
    """(start, end, instance, seed, patterns) the plain way."""
    found = [(a, b, True) for spans in plain(text).values() for a, b in spans]
    for m in re.finditer(r"(?<![A-Za-z0-9._%+@()-])[A-Za-z0-9._%+@()-]{6,}", text):
        hit = m[0]
        number = re.fullmatch(r"[0-9().+-]+", hit) and len(re.sub("[^0-9]", "", hit)) >= pii.DIGITS
        if (number or re.match(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]", hit)) and not any(
            a < m.end() and m.start() < b for a, b, seed in found if seed
        ):
            found.append((*m.span(), False))
    out = []
    for a, b, seed in found:
        tokens = tokenised(text[:a])
        kind = "address" if "@" in text[a:b] else "number"
        goes_on = regex.fullmatch(RUN, text[a]) and a and regex.fullmatch(RUN, text[a - 1])
        patterns = [f"{kind} {tokens[-2]} {tokens[-1]}".lower()] if len(tokens) > 1 and not goes_on else []
        out.append((a, b, text[a:b].lower(), seed, patterns))
    return out


def plain_discovery(texts):
    edges = defaultdict(dict)
    every = [mentions_of(t) for t in texts]
    for own in every:
        for _, _, instance, seed, patterns in own:
            for p in patterns:
                edges[p][instance] = max(seed, edges[p].get(instance, False))
    times, seen = defaultdict(int), defaultdict(int)
    for text, own in zip(texts, every):
        for *_, patterns in own:
            for p in patterns:
                times[p] += 1
        tokens = tokenised(text)
        for a, b in zip(tokens, tokens[1:]):
            seen[f"{a} {b}".lower()] += 1
    edges = {
        p: own for p, own in edges.items()
        if len(own) >= pii.SUPPORT and p.split(" ", 1)[1] in seen and times[p] >= pii.SELECTIVE * seen[p.split(" ", 1)[1]]
    }
    score = {(p, i): float(s) for p, own in edges.items() for i, s in own.items()}
    for _ in range(pii.ROUNDS):
        kept = {}
        for p, own in edges.items():
            belief = sum(score[p, i] for i in own) / (len(own) + pii.PRIOR)
            if belief >= pii.CONFIDENT and sum(score[p, i] >= pii.CONFIDENT for i in own) >= pii.SUPPORT:
                kept[p] = belief
        chance = defaultdict(float)
        for p, belief in kept.items():
            for i, seed in edges[p].items():
                if not seed:
                    chance[i] += math.log(1 - min(belief, 0.999))
        chance = {i: 1 - math.exp(x) for i, x in chance.items()}
        score = {(p, i): 1.0 if edges[p][i] else chance.get(i, 0.0) for p, i in score}
    return [
        sorted({(a, b) for a, b, i, seed, patterns in own
                if not seed and chance.get(i, 0) >= pii.CONFIDENT and any(p in kept for p in patterns)})
        for own in every
    ]


def contextual(seed):
    draw = random.Random(seed)
    words = ["the", "of", "call", "me", "mail", "to", "is", "number", "größe", "list", "item"]
    digits = lambda n: "".join(draw.choices("0123456789", k=n))
    entity = [
        lambda: f"Phone: +1 ({digits(3)}) 555-{digits(4)}",
        lambda: f"call me at +49 {digits(3)} {digits(7)}",
        lambda: f"mail to {draw.choice('abcdefgh')}{digits(3)}@mail{digits(1)}.example.com",
        lambda: f"server host= 10.{draw.randint(0, 255)}.0.{draw.randint(0, 255)}",
    ]
    unseen = [
        lambda: f"phone: 555-{digits(4)}", lambda: f"call me at 0{digits(8)}", lambda: f"mail to joe{digits(3)}@localhost",
        lambda: f"part number {digits(8)}", lambda: f"order id: {digits(9)}", lambda: "host= 10.999.0.1",
    ]
    texts = []
    for _ in range(220):
        parts = draw.choices(words, k=draw.randint(1, 20))
        if draw.random() < 0.7:
            parts.append(draw.choice(entity)())
        if draw.random() < 0.15:
            parts.append(draw.choice(unseen)())
        parts += draw.choices(words, k=draw.randint(0, 6))
        texts.append(" ".join(parts))
    return texts + ["phone: 555-1212", "", "Phone:\n 555-1212 555-1313"]


@pytest.mark.parametrize("seed", range(2))
def test_discovery(spark, seed):
    texts = contextual(seed)
    rows = [(i, t, "r", []) for i, t in enumerate(texts)] + [(None, None, "r", []), (0, texts[0], "r", [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, context array<int>")
    want = plain_discovery([t or "" for _, t, _, _ in rows])
    got = pii.personal_data(df).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: w for r, w in zip(rows, want)}
    for r in got:
        assert [(p["start"], p["end"]) for p in r["context"]] == by_id[r.doc_id]
    assert sum(map(len, want)) > 10
    cut = [texts[i][a:b] for i, w in enumerate(want[: len(texts)]) for a, b in w]
    assert "555-1212" in cut


@pytest.mark.parametrize("elsewhere, reported", [(0, 2), (400, 0)])
def test_words_of_documents_without_a_mention_count(spark, elsewhere, reported):
    """The words come before 22 mentions; when they are in 400 other places as well, they announce nothing."""
    texts = [f"order number 10.0.0.{i}" for i in range(20)] + [f"order number 5550{i}1234" for i in range(2)]
    texts += ["an order number that is not here"] * elsewhere
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sum(len(r["context"]) for r in pii.personal_data(df).collect()) == reported


@pytest.mark.parametrize("elsewhere, reported", [("", 1), ("ref=word", 0)])
def test_contexts_that_touch_the_mention(spark, elsewhere, reported):
    """A cue before the mention without a blank is counted like any other, wherever it is."""
    texts = [f"see ref={411111111111 + i}{check_digit(411111111111 + i)}" for i in range(20)] + ["see ref=1234567"]
    texts += [f"see {elsewhere}"] * 2000
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sum(len(r["context"]) for r in pii.personal_data(df).collect()) == reported


def check_digit(number):
    return next(c for c in "0123456789" if luhn(f"{number}{c}"))


def test_contexts_reach_as_far_back_as_they_need(spark):
    """Tokens and blanks of hundreds of characters, and mentions at the start, after one token, or inside a run."""
    wide = "w" * 300
    texts = ["10.0.0.1", "a 10.0.0.1", f"{wide} at 10.0.0.1", f"x {wide}10.0.0.1", "host" + " " * 200 + "is" + "\n" * 100 + "10.0.0.1",
             "(((10.0.0.1", "größe: 10.0.0.1", "a" + " " * 63 + ": 10.0.0.1", f"{wide}{wide}:10.0.0.1", "ab+1 (555) 555-1234", "é" * 64 + ":10.0.0.1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.entities(df).collect():
        own = [(m["start"], m["end"], m["instance"], m["seed"], m["patterns"]) for m in r.mentions]
        assert sorted(own) == sorted(mentions_of(texts[r.doc_id]))


def test_planted_contexts(spark):
    """Identifiers that no base pattern has, in contexts that mostly announce base matches: recall and precision."""
    draw = random.Random(8)
    digits = lambda n: "".join(draw.choices("0123456789", k=n))
    texts, planted = [], 0
    for _ in range(900):
        parts = draw.choices(["the", "list", "of", "parts", "number", "is", "here", "today"], k=draw.randint(3, 25))
        if draw.random() < 0.4:
            parts.append(draw.choice([f"mobile phone +1 {digits(3)} 555 {digits(4)}", f"mail me: {draw.choice('abc')}{digits(4)}@mail.example.com"]))
        if draw.random() < 0.06:
            planted += 1
            parts.append(draw.choice([f"mobile phone {digits(3)}-555-{digits(4)}", f"mail me: joe{digits(3)}@localhost"]))
        if draw.random() < 0.3:
            parts.append(draw.choice([f"part number {digits(9)}", f"the list {digits(8)}", f"of parts {digits(7)}"]))
        texts.append(" ".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [texts[r.doc_id][p["start"] : p["end"]] for r in pii.personal_data(df).collect() for p in r["context"]]
    right = sum("-555-" in hit or "localhost" in hit for hit in found)
    assert right >= 0.9 * planted and right == len(found)


def test_query_and_empty_table(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = pii.op8_pii(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(want[k]) for k in pii.KINDS]
        base = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in want[k])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans.startswith(base)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(empty).count() == 0
