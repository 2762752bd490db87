from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarlens.functions.dates import iso_weekday, month_of, months_apart, parse_date
from bazaarlens.functions.numeric import average_money, cents, mean, money, percent
from bazaarlens.functions.text import natural_key, standard_city, title_case
from bazaarlens.operators.metrics import revenue_label

from conftest import rows


def one(spark, schema: str, values: tuple, *columns):
    return rows(spark.createDataFrame([values], schema).select(*columns))[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-11-05", dt.date(2024, 11, 5)),
        (" 2024-11-05 ", dt.date(2024, 11, 5)),
        ("2024-11-05 10:30:00", dt.date(2024, 11, 5)),
        ("05/11/2024", dt.date(2024, 5, 11)),  # fits two patterns, month first wins
        ("25/11/2024", dt.date(2024, 11, 25)),
        ("11-05-2024", dt.date(2024, 11, 5)),
        ("05-Nov-2024", dt.date(2024, 11, 5)),
        ("0987-01-02", dt.date(987, 1, 2)),
        ("2024-02-30", None),
        ("31/31/2024", None),
        ("soon", None),
        ("  ", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, expected):
    assert one(spark, "s string", (text,), parse_date(F.col("s"))) == (expected,)


def test_parse_date_pattern_order_is_a_parameter(spark):
    day_first = parse_date(F.col("s"), ["d/M/yyyy", "M/d/yyyy"])
    assert one(spark, "s string", ("05/11/2024",), day_first) == (dt.date(2024, 11, 5),)


@pytest.mark.parametrize(
    ("text", "expected"),
    [("o'neil-SMITH  road", "O'Neil-Smith  Road"), ("new_delhi 2b", "New_Delhi 2b"), ("", ""), (None, None)],
)
def test_title_case(spark, text, expected):
    assert one(spark, "s string", (text,), title_case(F.col("s"))) == (expected,)


def test_standard_city_and_natural_key(spark):
    columns = (standard_city(F.col("s")), natural_key(F.col("s")))
    assert one(spark, "s string", ("  nEW delhi ",), *columns) == ("New Delhi", "new delhi")
    assert one(spark, "s string", ("   ",), *columns) == (None, "")


def test_calendar_helpers(spark):
    when = (dt.datetime(2024, 3, 31, 23, 59), dt.date(2023, 11, 1))
    found = one(
        spark,
        "t timestamp_ntz, d date",
        when,
        month_of("t"),
        months_apart(month_of("t"), F.col("d")),
        iso_weekday(F.col("t").cast("date")),
    )
    assert found == (dt.date(2024, 3, 1), 4, 7)


def test_ratios_round_half_up_and_survive_zero(spark):
    columns = (percent("a", "b"), mean("a", "b", 2), percent("a", "z"), mean("a", "z", 1))
    found = one(spark, "a bigint, b bigint, z bigint", (1, 8, 0), *columns)
    assert found == (Decimal("12.5"), Decimal("0.13"), None, None)
    assert one(spark, "a bigint, b bigint", (-1, 8), mean("a", "b", 2)) == (Decimal("-0.13"),)


def test_money_round_trip(spark):
    found = one(
        spark,
        "m decimal(12,2), n bigint",
        (Decimal("-1234567890.05"), 2),
        cents("m"),
        money(cents("m")),
        average_money(cents("m"), "n"),
    )
    assert found == (-123456789005, Decimal("-1234567890.05"), Decimal("-617283945.03"))


@pytest.mark.parametrize(
    ("value", "label"),
    [
        ("123456789.00", "12.35 Cr"),
        ("10000000.00", "1.00 Cr"),
        ("9999999.99", "100.00 L"),
        ("412500.00", "4.13 L"),
        ("99999.49", "99,999"),
        ("0.50", "1"),
    ],
)
def test_revenue_label(spark, value, label):
    assert one(spark, "v decimal(24,2)", (Decimal(value),), revenue_label(F.col("v"))) == (label,)
