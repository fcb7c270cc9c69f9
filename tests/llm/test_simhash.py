"""Fingerprints bit by bit, links against all pairs, components against union-find."""

from __future__ import annotations

import random

import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values: dict[int, int]) -> dict[int, int]:
    """doc_id by fingerprint to component, over all pairs."""
    parent = {d: d for d in values}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(values)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (values[a] ^ values[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints():
    draw = random.Random(1)
    texts = [None, "", " \t\n", "One", "a B c", "Straße ÄÖ été 1 2 3", "x " * 5000, "a\x0bb\x0cc d e", "a b c d e"]
    texts += [" ".join(draw.choices(["ab", "cd", "Ef", "g.", "ñ"], k=draw.randint(1, 60))) for _ in range(60)]
    for text in texts:
        assert simhash.fingerprint(text.encode() if text is not None else None) == plain_fingerprint(text)


def test_keys_are_two_balls_of_radius_one(spark):
    fps = [0, 1, (1 << 64) - 1, 0x0123456789ABCDEF, 0xFEDCBA9876543210]
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for r in df.select("fp", simhash._keys(df["fp"]).alias("keys")).collect():
        x = r.fp % (1 << 64)
        flips = [0] + [1 << b for b in range(32)]
        want = [(x >> 32) ^ m for m in flips] + [(x & 0xFFFFFFFF | 1 << 40) ^ m for m in flips]
        assert sorted(r["keys"]) == sorted(want)


def planted(draw: random.Random, centres: int, each: int) -> list[int]:
    out = []
    for _ in range(centres):
        x = draw.getrandbits(64)
        out.append(x)
        for _ in range(each):
            for b in draw.sample(range(64), draw.randint(1, 6)):
                x ^= 1 << b
            out.append(x)
    return sorted(set(out))


def linked(spark, fps, **how):
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    found = simhash.links(df, len(fps), **how)
    roots = {r.node: r.root for r in components(found).collect()}
    groups = {}
    for x in fps:
        groups.setdefault(roots.get(signed(x), signed(x)), set()).add(x)
    return sorted(sorted(g) for g in groups.values())


def expected(fps):
    parts = plain_components({i: x for i, x in enumerate(fps)})
    groups = {}
    for i, x in enumerate(fps):
        groups.setdefault(parts[i], set()).add(x)
    return sorted(sorted(g) for g in groups.values())


def test_links_against_all_pairs(spark):
    fps = planted(random.Random(2), 40, 8)
    assert linked(spark, fps) == expected(fps)


def test_crowded_and_overfull_keys_lose_no_link(spark):
    draw = random.Random(3)
    centre = draw.getrandbits(64)
    crowd = {centre}
    while len(crowd) < 60:
        crowd.add(centre ^ sum(1 << b for b in draw.sample(range(64), 3)))
    fps = sorted(crowd | set(planted(draw, 5, 5)))
    assert linked(spark, fps, crowded=10) == expected(fps)  # found beforehand
    assert linked(spark, fps, crowded=10, sample=30) == expected(fps)  # by a sample, or in the task


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 3)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert len({roots[i] for i in range(1, 201)}) == 1
    assert len({roots[1000 + i] for i in range(300)}) == 1
    assert roots[1] != roots[1000] and 5000 not in roots
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    draw = random.Random(4)
    base = [" ".join(draw.choices("abcdefghijklmnop", k=120)) for _ in range(12)]
    texts = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        own = t.split(" ")
        own[draw.randrange(120)] = "zz"
        texts += [(100 + i, " ".join(own)), (200 + i, t.upper())]
    texts += [(300, None), (301, ""), (302, "one"), (302, "one"), (None, "one")]
    rows = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, fp int, component_id int")
    got = simhash.near_duplicates(rows).collect()
    assert len(got) == len(texts)
    values = {d: plain_fingerprint(t) for d, t in texts if d is not None}
    parts = plain_components(values)
    for r in got:
        if r.doc_id is not None:
            assert (r.fp, r.component_id) == (signed(values[r.doc_id]), parts[r.doc_id])
    assert {r.component_id for r in got if r.doc_id is None} == {302}


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(rows).count() == 0


def test_query_on_its_table(spark, sf):
    rows = {r.doc_id: r for r in simhash.op9_simhash(spark, sf).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    values = {d: plain_fingerprint(t) for d, t in docs.items()}
    parts = plain_components(values)
    assert {d: (r.fingerprint, r.component_id) for d, r in rows.items()} == {
        d: (f"{values[d]:016x}", parts[d]) for d in docs
    }
