from __future__ import annotations

import datetime as dt
import json

import pytest

from tests.helpers import message
from tidemark import schemas
from tidemark.functions import decode as wire

GOOD = (
    '{"reading_id":40417,"device_id":"pump-7","event_time":"2031-02-05T06:40:17.250",'
    '"energy_usage":0.75,"temperature":19.5,"vibration":0.3,"signal_strength":61}'
)
WHEN = dt.datetime(2031, 2, 5, 6, 40, 17, 250000)


def one(spark, text, schema=schemas.TELEMETRY):
    messages = spark.createDataFrame([(text,)], "value string")
    return wire.decode(messages, schema).first()


def test_good_message(spark):
    row = one(spark, GOOD)
    assert row.quarantine_reason is None
    assert tuple(row)[:7] == (40417, "pump-7", WHEN, 0.75, 19.5, 0.3, 61)


@pytest.mark.parametrize(
    "spoil, column",
    [
        (lambda m: m.replace("05T06", "05 06"), "event_time"),
        (lambda m: m.replace(".250", ".250+00:00"), "event_time"),
        (lambda m: m.replace(".250", ".250Z"), "event_time"),
        (lambda m: m.replace("2031-02", "2031-92"), "event_time"),
        (lambda m: m.replace('"temperature":19.5,', ""), "temperature"),
        (lambda m: m.replace("19.5", '"hot"'), "temperature"),
        (lambda m: m.replace(":61", ":61.5"), "signal_strength"),
        (lambda m: m.replace("40417", "99999999999999999999"), "reading_id"),
    ],
)
def test_one_bad_field_is_null_and_the_rest_survive(spark, spoil, column):
    row = one(spark, spoil(GOOD))
    good = one(spark, GOOD)
    assert row.quarantine_reason is None
    assert row[column] is None
    for other in schemas.TELEMETRY.names:
        if other != column:
            assert row[other] == good[other]


def test_two_bad_fields(spark):
    row = one(spark, GOOD.replace("19.5", '"x"').replace("0.3", "[]"))
    assert (row.temperature, row.vibration, row.energy_usage, row.event_time) == (None, None, 0.75, WHEN)


def test_number_in_quotes_is_read(spark):
    assert one(spark, GOOD.replace("19.5", '"19.5"')).temperature == 19.5


@pytest.mark.parametrize(
    "text, reason",
    [
        (None, "null_message"),
        ("not json", "not_json"),
        (GOOD[:70], "not_json"),
        ("[1, 2]", "not_json"),
        ("{}", "no_device_id"),
        (GOOD + GOOD, "goes_on"),
        (GOOD + " and more", "goes_on"),
        (GOOD + "}", "goes_on"),
        (GOOD[:-1] + ',"extra":{"a":"}"}} x', "goes_on"),
        (GOOD.replace('"pump-7"', "null"), "no_device_id"),
    ],
)
def test_quarantine(spark, text, reason):
    assert one(spark, text).quarantine_reason == reason


@pytest.mark.parametrize("text", [GOOD + " \n", GOOD.replace("pump-7", "a} {b"), GOOD.replace("pump-7", 'q\\"} x'),
                                  GOOD[:-1] + ',"extra":{"a":1}}'])
def test_braces_inside_a_message_are_no_second_one(spark, text):
    assert one(spark, text).quarantine_reason is None


@pytest.mark.parametrize("number", ["NaN", "Infinity", "-Infinity", '"NaN"', '"Infinity"'])
def test_a_number_that_is_not_finite_is_bad(spark, number):
    row = one(spark, GOOD.replace("19.5", number))
    assert (row.temperature, row.vibration, row.quarantine_reason) == (None, 0.3, None)


def test_sparse_union_leaves_other_types_null(spark):
    text = json.dumps({"device_id": "device_1", "event_time": "2024-01-01T00:00:00.000", "severity": "low",
                       "event_type": "failure", "error_code": "ERR1000", "component": "motor", "root_cause": "wear"})
    row = one(spark, text, schemas.EVENTS)
    assert (row.error_code, row.component, row.root_cause) == ("ERR1000", "motor", "wear")
    assert [row[c] for c in ("technician", "duration_min", "parts_replaced", "status", "next_inspection_days")] == [None] * 5


def test_fraction_is_kept_to_milliseconds(spark):
    assert one(spark, GOOD.replace(".250", ".250999")).event_time == WHEN
    assert one(spark, GOOD.replace(".250", "")).event_time == WHEN.replace(microsecond=0)


def test_accepted_and_quarantined_split_the_messages(spark):
    lines = [message(1), "nope", message(2), None]
    decoded = wire.decode(spark.createDataFrame([(x,) for x in lines], "value string"), schemas.TELEMETRY)
    assert wire.accepted(decoded, schemas.TELEMETRY).schema == schemas.TELEMETRY
    assert sorted(r.reading_id for r in wire.accepted(decoded, schemas.TELEMETRY).collect()) == [1, 2]
    assert sorted(r.reason for r in wire.quarantined(decoded).collect()) == ["not_json", "null_message"]


def test_a_second_message_is_noticed_however_deep_the_first_nests(spark):
    deep = '{"device_id":"d","x":' + '{"y":' * 5 + '"}{"' + "}" * 5 + "}"
    texts = {
        deep: None, deep + "  \n": None, deep + ' {"device_id":"e"}': "goes_on", deep + " 5": "goes_on", deep + "}": "goes_on",
        '{"device_id":"d","x":[{"a":{"b":1}},{"c":2}]}': None, '{"device_id":"d","x":[{"a":{"b":1}}]} {"device_id":"e"}': "goes_on",
    }
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    for r in wire.decode(df, schemas.TELEMETRY).collect():
        assert r.quarantine_reason == texts[r.value], r.value
