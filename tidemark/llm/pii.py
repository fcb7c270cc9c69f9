"""Personal data: base patterns, and identifiers that bootstrapped contexts discover. DataFrame operations only.

Base matches come with their places from two readings of a text by one pattern: ``split`` gives what lies between the
matches, ``regexp_extract_all`` the matches, and the lengths of both add up to the places. Patterns are written with
possessive quantifiers and start where a run starts, so they match what the contract's do without trying a run of n
characters n times, and without recursion.

The method, on the entities found:

1. Seeds are the base matches. Candidates are tokens of their shapes that no base match covers: ``address`` (with an
   ``@``) and ``number`` (digits and ``().+-``, at least ``DIGITS`` digits).
2. A text is read as tokens: a run of letters, digits and ``_``, or one other visible character. The lexical pattern of a
   mention is its shape with the two tokens before it, in lower case, however far back they reach; a mention that goes on
   from a run of letters or digits has none. Only patterns with ``SUPPORT`` different instances count whose two tokens,
   wherever they are neighbours in any document, are followed by a mention at least ``SELECTIVE`` of the time: "of the" is no sign
   of personal data.
3. The graph links each pattern to each different instance it precedes. A seed's score is 1. In each of ``ROUNDS``
   rounds a pattern's score is the mean score of its instances (with ``PRIOR`` unknown ones added), patterns that
   reach ``CONFIDENT`` with ``SUPPORT`` or more believed instances are kept, and an instance's score is the chance that not all of its
   kept patterns are wrong.
4. A candidate mention is personal data when one of its own patterns is kept and its instance reaches ``CONFIDENT``.

Scoring shuffles (pattern, instance) once per different pair, combined map-side, so neither a common context nor a
common number weighs on one task; skewed joins are left to adaptive execution. Every round's tables are written.
The tokens of all texts are read once more for step 2 and counted before anything is joined; pairs that no supported
pattern has are mostly told by a bitmap of ``BITS`` bits and not counted, and no other pair's count is used.

Spans are in code points with the end exclusive, by kind (email, ip, card, phone, context) and start. Null texts count
as empty; rows that repeat an id get a row each. Ids are cast to long. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import scratch, table

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

#: Each matches what the contract's pattern of that kind matches, but for matches that its condition drops anyway.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A part of at most 255, of a match whose parts all have digits.
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
#: Runs a candidate can be.
TOKEN = r"(?<![A-Za-z0-9._%+@()-])[A-Za-z0-9._%+@()-]{6,}+"

DIGITS = 7
ROUNDS = 3
PRIOR = 1.0
CONFIDENT = 0.8
SUPPORT = 4
SELECTIVE = 0.2
#: Characters before a mention that are looked at first; where its two tokens reach farther back, all are.
REACH = 64
#: Bits that tell which pairs of tokens may be those of a supported pattern.
BITS = 1 << 20
_RUN = r"[\p{L}\p{M}\p{N}_]"
PIECE = rf"(?:{_RUN}++|[^\s\p{{L}}\p{{M}}\p{{N}}_])"

_PLACE = "struct<start:int,end:int,hit:string>"


def places(text: Column, pattern: str) -> Column:
    """start, end and hit of all matches."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("hit")
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_PLACE}>").alias("out"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        end = start + F.length(piece["hit"])
        found = F.array(F.struct(start.alias("start"), end.alias("end"), piece["hit"].alias("hit")))
        # The last gap has no match after it; nothing follows, so the place it leaves behind is not used.
        return F.struct(
            F.coalesce(end, state["at"]).alias("at"),
            F.when(piece["hit"].isNull(), state["out"]).otherwise(F.concat(state["out"], found)).alias("out"),
        )

    return F.aggregate(pieces, empty, step)["out"]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the check, from the right, every second doubled."""
    turned = F.reverse(digits(value))

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substr(turned, i, F.lit(1))) - 48
        twice = 2 * d
        return total + F.when(i % 2 == 1, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Places per kind. Each costs a text that cannot hold the kind one quick look."""
    none = F.array().cast(f"array<{_PLACE}>")
    count = lambda hit: F.length(digits(hit))
    wanted = {
        "email": (F.contains(text, F.lit("@")), EMAIL, lambda hit: F.lit(True)),
        "ip": (text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), IP, lambda hit: hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        "card": (
            text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), CARD,
            lambda hit: F.when(count(hit).between(13, 19), luhn(hit)).otherwise(False),
        ),
        "phone": (F.contains(text, F.lit("+")), PHONE, lambda hit: count(hit).between(9, 15)),
    }
    return {
        kind: F.when(likely, F.filter(places(text, pattern), _holds(ok))).otherwise(none)
        for kind, (likely, pattern, ok) in wanted.items()
    }


def _holds(ok):
    return lambda place: ok(place["hit"])


def candidates(text: Column) -> Column:
    """Tokens of the shapes that entities have."""

    def shaped(place: Column) -> Column:
        hit = place["hit"]
        address = hit.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]")
        number = hit.rlike(r"^[0-9().+-]+$") & (F.length(digits(hit)) >= DIGITS)
        return address | number

    likely = text.rlike(r"@|[0-9](?:[().+-]*+[0-9]){6}")
    return F.when(likely, F.filter(places(text, TOKEN), shaped)).otherwise(F.array().cast(f"array<{_PLACE}>"))


def shape(hit: Column) -> Column:
    return F.when(F.contains(hit, F.lit("@")), "address").otherwise("number")


def contexts(hit: Column, text: Column, start: Column) -> Column:
    """The lexical pattern of a mention as an array of one, or of none: its shape and the two tokens before it."""
    pair = rf"^\s*+({PIECE})\s*+({PIECE})"

    def before(chars: Column) -> Column:
        return F.reverse(F.substring(text, start - chars + 1, chars))

    # Read backwards. In the part looked at first the farther token must end before the part does.
    near, whole = before(F.least(start, F.lit(REACH))), before(start)
    back = F.when(near.rlike(pair + r"[\s\S]"), near).otherwise(whole)
    last, second = (F.reverse(F.regexp_extract(back, pair, i)) for i in (1, 2))
    goes_on = hit.rlike(f"^{_RUN}") & near.rlike(f"^{_RUN}")
    pattern = F.lower(F.concat_ws(" ", shape(hit), second, last))
    return F.when((second != "") & ~goes_on, F.array(pattern)).otherwise(F.array().cast("array<string>"))


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, a column of places per kind, and mentions.

    mentions: start, end, instance (lower case), seed (whether it is a base match) and patterns.
    """
    # The text is a column of its own, so that what the lambdas below refer to is never computed again.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumns(base_spans(F.col("text")))
    rows = rows.withColumn("others", candidates(F.col("text")))

    def mention(seed: bool):
        def make(p: Column) -> Column:
            return F.struct(
                p["start"].alias("start"), p["end"].alias("end"), F.lower(p["hit"]).alias("instance"),
                F.lit(seed).alias("seed"), contexts(p["hit"], F.col("text"), p["start"]).alias("patterns"),
            )

        return make

    seeds = F.flatten(F.array(*[F.col(k) for k in KINDS]))
    free = F.filter(
        "others", lambda o: ~F.exists("all_seeds", lambda s: (s["start"] < o["end"]) & (o["start"] < s["end"]))
    )
    rows = rows.withColumn("all_seeds", seeds)
    mentions = F.concat(F.transform("all_seeds", mention(True)), F.transform(free, mention(False)))
    return scratch(rows.select("row", "doc_id", *KINDS, mentions.alias("mentions")), "pii")


def _read_contexts(texts: DataFrame) -> DataFrame:
    """context: every two neighbouring tokens of each text of ``texts`` (text)."""
    tokens = texts.where("text IS NOT NULL").select(F.regexp_extract_all("text", F.lit(f"({PIECE})"), F.lit(1)).alias("t"))
    pairs = tokens.select(F.explode(F.arrays_zip(F.col("t").alias("a"), F.slice("t", 2, F.size("t")).alias("b"))).alias("w"))
    return pairs.where("w.b IS NOT NULL").select(F.lower(F.concat_ws(" ", "w.a", "w.b")).alias("context"))


def _place(context: str) -> Column:
    return F.pmod(F.xxhash64(context), F.lit(BITS))


def _bitmap(contexts: DataFrame) -> Column:
    """An array of ``BITS`` bits, 64 a number, those of ``contexts`` (context) set."""
    words = contexts.select(_place("context").alias("at")).select(
        F.floor(F.col("at") / 64).alias("word"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("bit")
    )
    every = contexts.sparkSession.range(BITS // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    return (
        words.union(every).groupBy("word").agg(F.bit_or("bit").alias("bits"))
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"])).scalar()
    )


def _usable(links: DataFrame, texts: DataFrame, support: int, selective: float) -> DataFrame:
    """pattern: those of ``links`` with enough instances, and tokens that mostly announce a mention in ``texts``."""
    shape_word = F.substring_index("pattern", " ", 1)
    some = scratch(
        links.groupBy("pattern").agg(F.count("*").alias("instances"), F.sum("times").alias("times"))
        .where(F.col("instances") >= support)
        .select("pattern", "times", F.substr("pattern", F.length(shape_word) + 2).alias("context")),
        "pii-supported",
    )
    wanted = scratch(some.select("context").distinct(), "pii-contexts")
    word = F.element_at(_bitmap(wanted), F.floor(_place("context") / 64).cast("int") + 1)
    maybe = F.expr("shiftright(word, CAST(pmod(xxhash64(context), 64) AS INT))").bitwiseAND(F.lit(1).cast("long")) == 1
    counted = (
        _read_contexts(texts).withColumn("word", word).where(maybe).groupBy("context").agg(F.count("*").alias("seen"))
    )
    # An inner join stays above the count, so it makes one row per wanted context and not one per pair of tokens.
    seen = counted.join(wanted, "context")
    # A mention's tokens are neighbours in its own text, so every pattern has been counted.
    return some.join(seen, "context").where(F.col("times") >= selective * F.col("seen")).select("pattern")


def kept_patterns(
    found: DataFrame, texts: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT, support: int = SUPPORT,
    selective: float = SELECTIVE,
) -> tuple[DataFrame, DataFrame]:
    """Patterns that are kept after the last round, and the instances they make believed (with their scores).

    ``texts`` has the text of every document, with a mention or without.
    """
    links = scratch(
        found.select(F.explode("mentions").alias("m"))
        .select(F.explode("m.patterns").alias("pattern"), "m.instance", F.col("m.seed").cast("double").alias("seed"))
        .groupBy("pattern", "instance")
        .agg(F.max("seed").alias("seed"), F.count("*").alias("times")),
        "pii-links",
    )
    usable = _usable(links, texts, support, selective)
    graph = scratch(links.join(scratch(usable, "pii-usable"), "pattern", "left_semi").drop("times"), "pii-graph")
    scored = graph.withColumn("score", F.col("seed"))
    for _ in range(rounds):
        patterns = scratch(
            scored.groupBy("pattern")
            .agg(
                (F.sum("score") / (F.count("*") + F.lit(PRIOR))).alias("belief"),
                F.sum((F.col("score") >= confident).cast("int")).alias("believed"),
            )
            .where((F.col("belief") >= confident) & (F.col("believed") >= support))
            .select("pattern", "belief"),
            "pii-patterns",
        )
        wrong = F.sum(F.log(1 - F.least("belief", F.lit(0.999))))
        instances = scratch(
            graph.where("seed = 0").join(patterns, "pattern").groupBy("instance").agg((1 - F.exp(wrong)).alias("chance")),
            "pii-instances",
        )
        scored = scratch(
            graph.join(instances, "instance", "left").select(
                "pattern", "instance", "seed",
                F.when(F.col("seed") > 0, F.lit(1.0)).otherwise(F.coalesce("chance", F.lit(0.0))).alias("score"),
            ),
            "pii-scored",
        )
    return patterns, instances.where(F.col("chance") >= confident)


def discovered(found: DataFrame, texts: DataFrame, **how) -> DataFrame:
    """row and context (places of the discovered mentions, in order) for rows that have any."""
    patterns, instances = kept_patterns(found, texts, **how)
    mentions = found.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    return (
        mentions.where("not seed")
        .select("row", "start", "end", "instance", F.explode("patterns").alias("pattern"))
        .join(patterns.select("pattern"), "pattern", "left_semi")
        .join(instances.select("instance"), "instance", "left_semi")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(CONTEXT))
    )


def _written(kind: str) -> Column:
    return F.transform(kind, lambda p: F.concat(F.lit(f"{kind}:"), p["start"], F.lit(":"), p["end"]))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a column of places (start, end) per kind, context among them, for every row."""
    found = entities(docs, id_col, text_col)
    all_kinds = [F.transform(k, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias(k) for k in KINDS]
    none = F.array().cast("array<struct<start:int,end:int>>")
    texts = docs.select(F.col(text_col).alias("text"))
    return found.join(discovered(found, texts), "row", "left").select("doc_id", *all_kinds, F.coalesce(CONTEXT, none).alias(CONTEXT))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.concat(*[_written(k) for k in KINDS])
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _written(CONTEXT)), ",").alias("spans"),
        F.size(CONTEXT).cast("long").alias("n_context"),
    )
