"""V2, V3, C2, C4, D2-D8: text parsing and dates."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import dates, money, parsing


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_v3_numbers(spark):
    texts = ["42.5", " 7 ", "1e3", ".5", "5.", "-3", "+2", "\t8\n"]
    assert apply(spark, parsing.parse_number, texts) == [42.5, 7.0, 1000.0, 0.5, 5.0, -3.0, 2.0, 8.0]


@pytest.mark.parametrize("text", ["one", "42.5d", "0x1p3", "NaN", "inf", "1_000", "true", "", " ", "1 2", ".", "e5"])
def test_v3_words_are_never_numbers(spark, text):
    assert apply(spark, parsing.parse_number, [text]) == [None]


def test_v2_timestamps(spark):
    texts = {
        "2026-06-02T02:09:22": datetime(2026, 6, 2, 2, 9, 22),
        "2026-06-02 02:09": datetime(2026, 6, 2, 2, 9),
        "2026-06-02T02": datetime(2026, 6, 2, 2),
        "2026-06-02": datetime(2026, 6, 2),
        "2026-06-02T02:09:22.25": datetime(2026, 6, 2, 2, 9, 22, 250000),
        "2026-06-02T02:09:22,25": datetime(2026, 6, 2, 2, 9, 22, 250000),
        "2026-06-02T02:09:22Z": datetime(2026, 6, 2, 2, 9, 22),
        "2026-06-02T02:09:22+02:00": datetime(2026, 6, 2, 0, 9, 22),
        "2026-06-02T22:09:22-0230": datetime(2026, 6, 3, 0, 39, 22),
        # Does not exist in the session's zone.
        "2026-03-08T02:30:00": datetime(2026, 3, 8, 2, 30),
    }
    assert apply(spark, parsing.parse_iso_timestamp, list(texts)) == list(texts.values())


@pytest.mark.parametrize(
    "text",
    ["yesterday", "", "2026-00-10T08:00:00", "2026/06/02 08:00", "2026", " 2026-06-02 ", "2026-02-30", "0000-01-01",
     "20260602", "2026-06-02T"],
)
def test_v2_unreadable_timestamps(spark, text):
    assert apply(spark, parsing.parse_iso_timestamp, [text]) == [None]


def test_d7_us_dates(spark):
    texts = ["1/2/2026", "01/02/2026", " 12/31/2025 ", "2/30/2026", "2026-01-02", "1/2/26", "", None]
    found = apply(spark, parsing.parse_us_date, texts)
    assert found == [date(2026, 1, 2), date(2026, 1, 2), date(2025, 12, 31), None, None, None, None, None]


def test_c2_strip_takes_all_whitespace(spark):
    assert apply(spark, parsing.strip, ["\t a b  \n"]) == ["a b"]
    assert apply(spark, parsing.blank_to_null, ["  ", " x "]) == [None, "x"]


def test_d4_boundaries_not_durations(spark):
    pairs = [
        (datetime(2026, 1, 1, 0, 59), datetime(2026, 1, 1, 1, 1)),
        (datetime(2026, 1, 1, 1, 1), datetime(2026, 1, 1, 0, 59)),
        (datetime(2026, 3, 8, 1, 59, 59), datetime(2026, 3, 8, 3, 0)),
        (None, datetime(2026, 1, 1)),
    ]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    a, b = F.col("a"), F.col("b")
    assert [tuple(r) for r in df.select(dates.hours_between(a, b), dates.minutes_between(a, b)).collect()] == [
        (1, 2), (-1, -2), (2, 61), (None, None)
    ]


def test_d1_d3_d5_calendar(spark):
    df = spark.createDataFrame([(date(2026, 3, 1),), (date(2026, 3, 7),), (date(2026, 3, 9),)], "d date")
    parts = dates.calendar_parts(F.col("d"))
    got = [tuple(r) for r in df.select(*[parts[n] for n in ("month_name", "day_name", "day_of_week", "is_weekend", "week_start")]).collect()]
    assert got == [
        ("March", "Sunday", 0, True, date(2026, 2, 23)),
        ("March", "Saturday", 6, True, date(2026, 3, 2)),
        ("March", "Monday", 1, False, date(2026, 3, 9)),
    ]


@pytest.mark.parametrize(
    "fee, cents, share, expected",
    [
        (7.34, 100.0, None, 1.0),
        (0.4, 100.0, None, 0.4),
        (7.34, 0.0, None, 0.0),
        (10.0, None, 80.0, 8.0),
        (10.0, 25.0, 80.0, 0.25),
        (10.0, None, None, 0.0),
        (None, 100.0, None, 1.0),
    ],
)
def test_u1_partner_fee_share(spark, fee, cents, share, expected):
    df = spark.createDataFrame([(fee, cents, share)], "fee double, cents double, share double")
    assert df.select(money.partner_fee_share(F.col("fee"), F.col("cents"), F.col("share"))).first()[0] == expected


def test_net_measures_keep_unknown_values_unknown(spark):
    df = spark.createDataFrame([(False, 5.0), (True, 5.0), (False, None), (True, None)], "void boolean, gross double")
    got = [r[0] for r in df.select(*money.net_measures(F.col("void"), {"net": "gross"})).collect()]
    assert got == [5.0, 0.0, None, 0.0]


def test_c10_round_half_up_despite_noise(spark):
    df = spark.createDataFrame([(123.45499999999998,), (1.005,)], "x double")
    assert [r[0] for r in df.select(money.round_total(F.col("x"))).collect()] == [123.46, 1.01]
