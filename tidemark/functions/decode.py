"""Tolerant JSON decoding of device messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Naive ISO-8601 with a "T" and no offset, kept to the millisecond.
ISO_NAIVE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?$"
ISO_MILLIS_WIDTH = 23

_BROKEN = "_broken"

# A JSON string; what is left without them has braces only where objects begin and end.
_STRING = r'(?s)"(?:[^"\\]++|\\.)*+"'


def iso_timestamp(text: Column) -> Column:
    """Naive ISO-8601 text to TIMESTAMP_NTZ at millisecond precision, NULL for any other form."""
    kept = F.substring(text, 1, ISO_MILLIS_WIDTH)
    return F.when(text.rlike(ISO_NAIVE), kept.try_cast("timestamp_ntz"))


def _finite(number: Column) -> Column:
    """NULL for NaN, which Spark takes to be over every threshold, and for infinities."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _goes_on() -> Column:
    """Whether text follows the object that was parsed, however deep it nests.

    Most messages need no more than a look for a brace. Of the others, strings go and then all but braces: the object ends
    with the brace at which as many were closed as opened, which is found by the running count over the few that are left.
    """
    bare = F.regexp_replace("value", _STRING, "")
    braces = F.split(F.regexp_replace(bare, r"[^{}]++", ""), "")
    step = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("end"))

    def count(state: Column, brace: Column) -> Column:
        at, depth = state["at"] + 1, state["depth"] + F.when(brace == "{", 1).when(brace == "}", -1).otherwise(0)
        ends = (state["end"] == 0) & (depth == 0) & (brace == "}")
        return F.struct(at.alias("at"), depth.alias("depth"), F.when(ends, at).otherwise(state["end"]).alias("end"))

    # Text after the last brace of the object, or braces after it.
    closed = F.aggregate(braces, step, count, lambda s: (s["end"] > 0) & (s["end"] < F.length(F.array_join(braces, ""))))
    after = F.rtrim(F.regexp_replace(F.substring_index(bare, "}", -1), r"\s", "")) != ""
    return (F.instr("value", "}") < F.length(F.rtrim("value"))) & (closed | after)


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.TimestampNTZType)


def _parse(schema: T.StructType, as_text: bool) -> Column:
    kinds = {f.name: "STRING" if as_text or _is_time(f) else f.dataType.simpleString() for f in schema}
    ddl = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + f", {_BROKEN} STRING"
    return F.from_json("value", ddl, {"columnNameOfCorruptRecord": _BROKEN})


def _field(field: T.StructField) -> Column:
    retried = F.col(f"_text.{field.name}")
    text = F.when(F.col(_BROKEN).isNull(), F.col(field.name)).otherwise(retried)
    if _is_time(field):
        return iso_timestamp(text)
    if isinstance(field.dataType, T.StringType):
        return text
    value = F.when(F.col(_BROKEN).isNull(), F.col(field.name)).otherwise(retried.try_cast(field.dataType))
    return _finite(value) if isinstance(field.dataType, T.DoubleType) else value


def decode(
    messages: DataFrame, schema: T.StructType, key: str = "device_id", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Decode ``messages.value`` into ``schema`` plus ``quarantine_reason``.

    A message that fits the types is parsed once. Any other is parsed again
    with every field as text and cast field by field, so a bad or absent field
    is NULL and its neighbours survive; a number that is not finite is bad. A
    message that is not one JSON object and no more, or that has no ``key``,
    gets a reason and is to be kept out of the tables.
    """
    # inline() keeps the parsed struct as one step; as a plain column the optimizer would repeat
    # the parse in every filter and projection above it.
    parsed = messages.select(*keep, "value", F.inline(F.array(_parse(schema, as_text=False))))
    retry = F.when(F.col(_BROKEN).isNotNull(), _parse(schema, as_text=True))
    parsed = parsed.select("*", F.explode(F.array(retry)).alias("_text"))
    reason = (
        F.when(F.col("value").isNull(), "null_message")
        .when(F.col(f"_text.{_BROKEN}").isNotNull(), "not_json")
        .when(_goes_on(), "goes_on")
        .when(F.coalesce(F.col(f"_text.{key}"), F.col(key)).isNull(), "no_" + key)
    )
    return parsed.select(
        *keep, *[_field(f).alias(f.name) for f in schema], reason.alias("quarantine_reason"), "value"
    )


def accepted(decoded: DataFrame, schema: T.StructType) -> DataFrame:
    return decoded.where(F.col("quarantine_reason").isNull()).select(*schema.names)


def with_set_aside(decoded: DataFrame) -> DataFrame:
    """Every message once: a row of the table, or its text and the reason it is none."""
    good = F.col("quarantine_reason").isNull()
    own = [F.when(good, F.col(c)).alias(c) for c in decoded.columns if c not in ("value", "quarantine_reason")]
    # A message that is NULL has no text, but a reason.
    return decoded.select(*own, F.when(~good, F.col("value")).alias("value"), "quarantine_reason")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("quarantine_reason").isNotNull()).select(
        "value", F.col("quarantine_reason").alias("reason")
    )
