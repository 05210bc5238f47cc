"""Scalar functions on hand-made values, above all where other engines differ."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftload.functions import codes, dates, numbers, text
from siftload.operators import filters

c = F.col


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("value, expected", [
    ("R12345R001", "R12345R001"), ("R12345R67890", "12345"), ("K77", "K77"), ("r12r001", "r12r001"), ("R12R", "12"), ("", ""), (None, None),
])
def test_customer_id(spark, value, expected):
    assert one(spark, text.normalise_customer_id(c("x")), value) == expected


@pytest.mark.parametrize("value, expected", [
    ("1 234,50 zł", 1234.5), ("zł", 0.0), ("'7'", 7.0), ("#N/A", 0.0), ("abc", 0.0), ("1e5", 0.0), ("", 0.0), (None, 0.0), ("-3,5", -3.5), ("1,2,3", 0.0), (".5", 0.5),
])
def test_money(spark, value, expected):
    assert one(spark, text.clean_money_text(c("x")), value) == expected


@pytest.mark.parametrize("value, expected", [("fix_a_12", "12"), ("plain", ""), ("a_", ""), ("_b", "b"), ("a_b  ", "b"), (None, None)])
def test_suffix(spark, value, expected):
    assert one(spark, text.suffix_after_underscore(c("x")), value) == expected


@pytest.mark.parametrize("value, expected", [("Mobile - tariff", "Mobile"), ("a-b", ""), ("-x", ""), ("none", "")])
def test_prefix_before_dash(spark, value, expected):
    assert one(spark, text.prefix_before_dash(c("x")), value) == expected


def test_substring_from_zero_gives_one_less(spark):
    assert one(spark, text.substring_fixed(c("x"), 0, 11), "2024-01-02 10:00") == "2024-01-02"


def test_whole_value_replacement_only(spark):
    assert one(spark, text.replace_whole_value(c("x"), "/", ""), "a/b") == "a/b"
    assert one(spark, text.replace_whole_value(c("x"), "/", ""), "/") == ""


@pytest.mark.parametrize("value, expected", [("TP\\Login", "login"), ("Login", "login")])
def test_login(spark, value, expected):
    assert one(spark, text.login_without_domain(c("x")), value) == expected


def test_control_chars(spark):
    assert one(spark, text.strip_control_chars(c("x")), "a\n\f\r;^b") == "ab"
    assert one(spark, text.strip_control_chars(c("x"), text.LINE_BREAKS), "a\n;\rb") == "a;b"


def test_sentinel_and_name(spark):
    assert one(spark, text.blank_if_null(text.sentinel_to_null(c("x"))), "null") == ""
    assert one(spark, text.concat_name(c("x"), F.lit(None).cast("string")), "a") is None


@pytest.mark.parametrize("code, free, expected", [(100, 7, 7), (24, 7, 24), (120, 7, 0), (None, 7, 0), (100, None, 0)])
def test_uniform_duration(spark, code, free, expected):
    df = spark.createDataFrame([(code, free)], "a int, b int")
    assert df.select(numbers.uniform_duration(c("a"), c("b")).alias("y")).first()["y"] == expected


@pytest.mark.parametrize("value, expected", [("#N/A", 0.0), ("", 0.0), ("2.345", 2.35), ("10", 10.0)])
def test_round_or_zero(spark, value, expected):
    assert one(spark, numbers.round_or_zero(c("x")), value) == expected


def test_round_or_zero_stops_at_other_text(spark):
    assert one(spark, numbers.round_or_zero(c("x")), None) is None
    with pytest.raises(Exception, match="not an amount: abc"):
        one(spark, numbers.round_or_zero(c("x")), "abc")


@pytest.mark.parametrize("value, kind, expected", [("12.9", "int", 12), ("x", "int", 0), (None, "double", 0.0), ("1e3", "double", 1000.0), ("--1", "double", 0.0), (" 5 ", "double", 5.0)])
def test_to_number(spark, value, kind, expected):
    assert one(spark, numbers.to_number_or_zero(c("x"), kind), value) == expected


def test_null_default_does_not_fail_under_ansi(spark):
    assert one(spark, numbers.number_or_zero(c("x")), None, "decimal(10,2)") == 0.0


@pytest.mark.parametrize("value, expected", [
    (datetime(2020, 10, 24, 12), "2020-10-24 14:00"), (datetime(2020, 10, 25), "2020-10-25 02:00"), (datetime(2020, 10, 25, 0, 1), "2020-10-25 01:01"),
    (datetime(2021, 3, 28), "2021-03-28 01:00"), (datetime(2023, 1, 1), "2023-01-01 02:00"),
])
def test_hour_shift_borders(spark, value, expected):
    shifted = dates.shift_hours_by_period(c("x"), dates.CAMPAIGN_HOUR_SHIFTS)
    assert one(spark, dates.date_to_text(shifted, dates.MINUTE_FORMAT), value, "timestamp_ntz") == expected


def test_zone_shift_knows_winter(spark):
    assert one(spark, dates.shift_to_zone(c("x")), datetime(2023, 1, 1), "timestamp_ntz") == datetime(2023, 1, 1, 1)
    assert one(spark, dates.shift_to_zone(c("x")), datetime(2023, 7, 1), "timestamp_ntz") == datetime(2023, 7, 1, 2)


def test_parse_timestamp(spark):
    assert one(spark, dates.parse_timestamp(c("x")), "2024-02-03 04:05:06") == datetime(2024, 2, 3, 4, 5, 6)
    assert one(spark, dates.parse_timestamp(c("x")), "nope") is None


def test_rules_first_hit_wins_and_null_is_no_hit(spark):
    rules = [(c("x") > 5, "big"), (c("x") > 1, "some")]
    for value, expected in ((9, "big"), (3, "some"), (0, ""), (None, "")):
        assert one(spark, codes.classify(rules), value, "int") == expected


def test_presence_label_lists_combinations_only(spark):
    df = spark.createDataFrame([(True, False), (True, True), (False, False)], "a boolean, b boolean")
    label = codes.presence_label({(True, False): "one", (True, True): "two"}, [c("a"), c("b")])
    assert [r["y"] for r in df.select(label.alias("y")).collect()] == ["one", "two", ""]


def test_keys_compare_without_case_and_trailing_blanks(spark):
    assert one(spark, text.equals_ignore_case(c("x"), F.lit("KEY")), "key  ") is True


def test_any_not_null(spark):
    df = spark.createDataFrame([(None, None), (None, 1)], "a int, b int")
    assert df.where(filters.any_not_null(c("a"), c("b"))).count() == 1
