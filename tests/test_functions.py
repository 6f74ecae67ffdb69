from __future__ import annotations

import hashlib

import pytest

from lumbung.functions import (
    completed_years, date_key, minute_key, minutes_between, money, padded_name, ratio, surrogate_key, whole_days_between,
)


def value(spark, text):
    return spark.sql(f"select {text} as v").first()["v"]


@pytest.mark.parametrize("day, years", [("2023-02-28", 22), ("2023-03-01", 23), ("2024-02-29", 24), ("2000-02-29", 0)])
def test_completed_years_on_leap_day(spark, day, years):
    assert value(spark, completed_years("date'2000-02-29'", f"date'{day}'")) == years


@pytest.mark.parametrize("amount, rounded", [("2.5d", 2), ("3.5d", 4), ("0.5d", 0), ("-2.5d", -2), ("2.51d", 3)])
def test_money_rounds_half_to_even(spark, amount, rounded):
    assert value(spark, money(amount)) == rounded


def test_durations(spark):
    start, end = "timestamp_ntz'2020-01-01 00:00:00'", "timestamp_ntz'2020-01-02 00:00:01.5'"
    assert value(spark, minutes_between(start, end)) == 1440.025
    assert value(spark, minutes_between(start, "cast(null as timestamp_ntz)")) is None
    assert value(spark, whole_days_between(start, end)) == 1
    assert value(spark, whole_days_between(end, start)) == -2


def test_durations_ignore_the_session_zone(spark):
    text = minutes_between("timestamp_ntz'2021-03-14 00:00:00'", "timestamp_ntz'2021-03-15 00:00:00'")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert value(spark, text) == 1440.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_keys(spark):
    ts = "timestamp_ntz'2024-01-09 23:05:59'"
    assert value(spark, date_key(ts)) == 20240109
    assert value(spark, minute_key(ts)) == 23 * 60 + 5
    assert value(spark, date_key("cast(null as timestamp_ntz)")) is None
    assert value(spark, padded_name(ts, "MMMM")) == "January  "
    assert value(spark, padded_name("date'2024-01-10'", "EEEE")) == "Wednesday"


def test_surrogate_key_of_mixed_types_and_null(spark):
    key = surrogate_key("7", "true", "timestamp_ntz'2020-01-01 00:00:00.25'", "cast(null as string)")
    expected = hashlib.md5(b"7||true||2020-01-01 00:00:00.25||_dbt_null_").hexdigest()
    assert value(spark, key) == expected


def test_ratio(spark):
    assert value(spark, ratio("1", "3")) == 1 / 3
    assert value(spark, ratio("1", "0")) is None
