import json
import math
from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from wardwatch import operators as ops
from wardwatch.schemas import EVENT_FIELDS

GOOD = {"case_number": "C1", "primary_type": "THEFT", "district": "008"}


def parse(spark, *values):
    data = [
        (i, bytearray(v if isinstance(v, bytes) else json.dumps(v).encode()))
        for i, v in enumerate(values)
    ]
    parsed = ops.parse_events(spark.createDataFrame(data, "n int, value binary"))
    return [r.asDict() for r in parsed.orderBy("n").collect()]


@pytest.mark.parametrize(
    "value, reason",
    [
        (b"\xff\xfe{}", "malformed"),
        (b'{"case_number": "C1", "prim', "malformed"),
        (b"", "malformed"),
        (b"[1]", "not_object"),
        (b"123", "not_object"),
        (b"null", "not_object"),
        (b'"text"', "not_object"),
        (b"{}", "missing_fields"),
        ({**GOOD, "district": None}, "missing_fields"),
        ({**GOOD, "district": ""}, "missing_fields"),
        ({**GOOD, "case_number": " \t\n"}, "missing_fields"),
        ({**GOOD, "case_number": "\xa0\u2003"}, "missing_fields"),
        ({"case_number": "C1", "district": "8"}, "missing_fields"),
        (GOOD, None),
        ({**GOOD, "district": 0}, None),
        ({**GOOD, "case_number": 17}, None),
    ],
)
def test_reasons(spark, value, reason):
    assert parse(spark, value)[0]["rejected"] == reason


BODY = json.dumps(GOOD)[:-1]


@pytest.mark.parametrize(
    "text",
    [
        BODY + "}",
        BODY + "} ",
        " \n" + BODY + "}",
        BODY + "} x",
        BODY + "}{}",
        BODY + "}}",
        BODY + "},{}",
        BODY + "}] ",
        BODY + "}],[1",
        BODY + ",}",
        BODY + ', "ward": 01}',
        BODY + ', "ward": tru}',
        BODY + ', "ward": "\\x"}',
        BODY + ', "ward": NaN}',
        BODY + ', "ward": [-Infinity , 1]}',
        BODY + ', "ward": "a: NaN, b"}',
        BODY + ', "ward": NaN} x',
        BODY + ', "district": "9"}',
        BODY.replace('"', "'") + "}",
        "\ufeff" + BODY + "}",
        "1,2",
        "[1] [2]",
        " ",
    ],
)
def test_what_is_json_is_what_python_takes(spark, text):
    try:
        expected = None if isinstance(json.loads(text), dict) else "not_object"
    except ValueError:
        expected = "malformed"
    assert parse(spark, text.encode())[0]["rejected"] == expected


def test_number_words_and_repeated_keys(spark):
    text = BODY + ', "latitude": NaN, "longitude": -Infinity, "district": "9"}'
    event = parse(spark, text.encode())[0]
    assert math.isnan(event["latitude"]) and event["longitude"] == -math.inf
    assert event["district"] == "9"


def test_absent_is_blank_and_null_stays(spark):
    absent, null = parse(spark, GOOD, {**GOOD, "block": None, "beat": 12, "arrest": None})
    assert list(absent) == ["n", *EVENT_FIELDS, "rejected"]
    assert absent["block"] == "" and absent["ingested_at"] == ""
    assert null["block"] is None and null["beat"] == "12"
    assert absent["arrest"] is False and null["arrest"] is False
    assert absent["latitude"] is None and absent["longitude"] is None
    assert absent["district"] == "008"


@pytest.mark.parametrize(
    "value, expected",
    [
        (True, True),
        (False, False),
        ("TRUE", True),
        ("true", True),
        ("yes", False),
        (" true", False),
        (1, False),
        (1.0, False),
    ],
)
def test_flags(spark, value, expected):
    assert parse(spark, {**GOOD, "arrest": value})[0]["arrest"] is expected


@pytest.mark.parametrize(
    "value, expected",
    [
        (41.8, 41.8),
        (41, 41.0),
        (1e30, 1e30),
        ("41.8", 41.8),
        (" -87.6 ", -87.6),
        ("1e2", 100.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("1_000.5", 1000.5),
        ("1__0", None),
        ("_1", None),
        ("\u20037\xa0", 7.0),
        ("x", None),
        ("1d", None),
        ("0x10", None),
        ("", None),
        (None, None),
        ([1], None),
        ("inf", math.inf),
    ],
)
def test_coordinates(spark, value, expected):
    assert parse(spark, {**GOOD, "latitude": value})[0]["latitude"] == expected


def test_nan_text_is_a_number(spark):
    assert math.isnan(parse(spark, {**GOOD, "latitude": "nan"})[0]["latitude"])


def test_routing(spark):
    districts = ["008", " 011 ", 8, 0, False, 0.0, "0", [], {"a": 1}]
    values = [{**GOOD, "district": d} for d in districts] + [{**GOOD, "district": ""}]
    data = [(i, bytearray(json.dumps(v).encode())) for i, v in enumerate(values)]
    messages = spark.createDataFrame(data, "n int, value binary")
    routed = ops.route_events(ops.parse_events(messages)).orderBy("n").collect()
    keys = [r["routed_district"] for r in routed]
    assert keys[:7] == ["008", "011", "8", "UNKNOWN", "UNKNOWN", "UNKNOWN", "0"]
    assert keys[7] == "UNKNOWN"
    assert len(keys) == 9


def test_stats_count_every_message_once(spark):
    values = [b"\xff", b"{", b"[1]", b"{}", json.dumps(GOOD).encode()]
    messages = spark.createDataFrame([(bytearray(v),) for v in values], "value binary")
    assert rows(ops.parse_stats(ops.parse_events(messages))) == [(5, 1, 2, 1, 1)]


def test_messages_from_rows(spark):
    source = spark.createDataFrame(
        [
            (" C1 ", "THEFT", " 8", "TRUE", "41.5", 'a "quoted"\nblock'),
            ("C2", "THEFT", None, "no", "x", None),
            ("", "THEFT", "8", None, None, None),
            ("C3", "  ", "8", None, None, None),
            (None, "THEFT", "8", None, None, None),
        ],
        "case_number string, primary_type string, district string, arrest string, "
        "latitude string, block string",
    )
    at = F.lit(datetime(2024, 5, 1, 10, 30, 0, 250))
    made = ops.to_event_messages(source, at).collect()
    assert [r["key"] for r in made] == ["8", None]
    first, second = (json.loads(bytes(r["value"])) for r in made)
    assert list(first) == EVENT_FIELDS
    assert first["case_number"] == "C1" and first["district"] == "8"
    assert first["arrest"] is True and first["domestic"] is False
    assert first["latitude"] == 41.5 and first["longitude"] is None
    assert first["block"] == 'a "quoted"\nblock' and first["beat"] == ""
    assert first["ingested_at"] == "2024-05-01T10:30:00.000250"
    assert second["arrest"] is False and second["latitude"] is None and second["block"] == ""


def test_messages_parse_back(spark):
    source = spark.createDataFrame(
        [("C1", "THEFT", "8", "true", 41.5)],
        "case_number string, primary_type string, district string, arrest string, latitude double",
    )
    event = ops.parse_events(ops.to_event_messages(source)).first()
    assert event["rejected"] is None and event["latitude"] == 41.5 and event["arrest"] is True
