import json
import random
import struct

import pytest

from recordlake.functions import text


def one(spark, kind, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in df.orderBy("i").selectExpr(f"{expression} AS r").collect()]


def test_numbers_are_printed_plain_from_1e_6_up_to_1e21(spark):
    given = {
        0.0: "0", 1.0: "1", 1.5: "1.5", -2.0: "-2", 0.1: "0.1", 1e7: "10000000", 123456789.25: "123456789.25",
        1e20: "100000000000000000000", 1e21: "1e+21", 0.001: "0.001", 0.0001: "0.0001", 0.000012: "0.000012",
        1e-7: "1e-7", -1.25e-9: "-1.25e-9", 6.02e23: "6.02e+23",
    }
    assert one(spark, "double", list(given), text.json_number("v")) == list(given.values())


def test_any_number_keeps_its_value(spark):
    rng = random.Random(7)
    values = [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(400)]
    values = [v for v in values if v == v and abs(v) != float("inf")] + [rng.uniform(-1e9, 1e9) for _ in range(200)]
    assert [float(t) for t in one(spark, "double", values, text.json_number("v"))] == values


def test_instants(spark):
    given = {
        "2024-01-01T00:00:00Z": "2024-01-01T00:00:00Z",
        "2024-01-01T00:00:00.120Z": "2024-01-01T00:00:00.12Z",
        "2024-01-01T00:00:00.1234567Z": "2024-01-01T00:00:00.123456Z",
        "2024-01-01T01:00:00+02:00": "2023-12-31T23:00:00Z",
        "2024-01-01T00:00:00": "2024-01-01T00:00:00Z",
        "1970-01-01T00:00:00Z": "1970-01-01T00:00:00Z",
        "12:30:00": None,
        "2024-01-01": None,
        "2024-13-01T00:00:00Z": None,
        "yesterday": None,
    }
    assert one(spark, "string", list(given), text.rfc3339(text.parse_instant("v"))) == list(given.values())


def test_instants_do_not_hang_on_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = one(spark, "string", ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00"], text.rfc3339(text.parse_instant("v")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2024-01-01T00:00:00Z"] * 2


@pytest.mark.parametrize("value", ["", "plain", 'a"b\\c', "<&>", "line\nbreak", "é  ", "tab\t"])
def test_strings_keep_their_value_and_hold_no_markup(spark, value):
    written = one(spark, "string", [value], text.json_string("v"))[0]
    assert json.loads(written) == value
    assert not set(written) & set("<>&  ")


def test_maps_come_out_sorted_and_never_null(spark):
    got = one(spark, "map<string,string>", [{"b": "1", "a": "<2>"}, {}, None], text.json_map("v"))
    assert got == ['{"a":"\\u003c2\\u003e","b":"1"}', "{}", "{}"]


def test_lists_are_never_null(spark):
    assert one(spark, "array<string>", [["x", "y"], [], None], text.json_list("v")) == ['["x","y"]', "[]", "[]"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instants_do_not_hang_on_the_session_time_zone(spark, zone):
    told = {
        "2024-11-03T06:30:00Z": "2024-11-03 06:30:00", "2024-11-03T01:30:00-04:00": "2024-11-03 05:30:00", "2024-03-10T02:30:00": "2024-03-10 02:30:00",
        "2024-03-31T01:30:00.123456789+05:30": "2024-03-30 20:00:00.123456", "2024-01-01T00:00:00+18:00": "2023-12-31 06:00:00",
        "2024-01-01T00:00:00+18:01": None, "2024-01-01T00:00:00+01:60": None, "2024-02-30T00:00:00Z": None, "12:30:00": None, "": None,
    }
    held = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in told], "t string").selectExpr("t", f"CAST({text.parse_instant('t')} AS STRING) AS at")
        assert {r.t: r["at"] for r in df.collect()} == told
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)
