import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelworks.functions import dates, money, sentinels, text

D = dt.date


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, day_first, month_first, stored",
    [
        ("2024-05-03", D(2024, 5, 3), D(2024, 5, 3), None),
        ("03-05-2024", D(2024, 5, 3), D(2024, 3, 5), D(2024, 5, 3)),
        ("13-05-2024", D(2024, 5, 13), D(2024, 5, 13), D(2024, 5, 13)),
        ("05/13/2024", D(2024, 5, 13), D(2024, 5, 13), None),
        ("2024-05-03 10:20:30", D(2024, 5, 3), D(2024, 5, 3), None),
        ("03-05-2024 10:20", D(2024, 5, 3), D(2024, 3, 5), None),
        ("2024/05/03", D(2024, 5, 3), D(2024, 5, 3), None),
        ("5 May 2024", D(2024, 5, 5), D(2024, 5, 5), None),
        ("15 October 2024", D(2024, 10, 15), D(2024, 10, 15), None),
        ("", None, None, None),
        ("  ", None, None, None),
        ("soon", None, None, None),
        (None, None, None, None),
        ("31-02-2024", None, None, None),
    ],
)
def test_date_parsing(spark, value, day_first, month_first, stored):
    assert one(spark, value, dates.parse_day_first) == day_first
    assert one(spark, value, dates.parse_month_first) == month_first
    assert one(spark, value, dates.parse_stored) == stored


def test_monday_week_matches_strftime(spark):
    days = [D(2023, 1, 1) + dt.timedelta(days=i) for i in range(0, 1500, 3)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", dates.monday_week(F.col("d"))
    )
    assert all(week == int(day.strftime("%W")) for day, week in got.collect())


def test_windows(spark):
    assert dates.month_window(2024, 2, D(2024, 5, 1)) == (D(2024, 2, 1), D(2024, 2, 29))
    assert dates.month_window(2024, 12, D(2025, 5, 1)) == (D(2024, 12, 1), D(2024, 12, 31))
    assert dates.month_window(2024, 5, D(2024, 5, 10)) == (D(2024, 5, 1), D(2024, 5, 9))
    as_of = D(2024, 5, 31)
    days = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i),) for i in range(200)], "d date")
    recent = [r[0] for r in days.where(dates.last_30_days(F.col("d"), as_of)).collect()]
    assert (min(recent), max(recent), len(recent)) == (D(2024, 5, 1), D(2024, 5, 30), 30)
    batch = [r[0] for r in days.where(dates.batch_window(F.col("d"), as_of)).collect()]
    assert (min(batch), max(batch)) == (D(2024, 3, 3), as_of)


@given(st.lists(st.floats(-1e7, 1e7, allow_nan=False), min_size=1, max_size=60))
@settings(max_examples=8, deadline=None)
def test_cents_is_numpy_round(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", money.cents(F.col("v")))
    assert all(np.round(v, 2) == r for v, r in got.collect())


@pytest.mark.parametrize(
    "value, number",
    [("1,234.5", 1234.5), ("", None), ("abc", None), (None, None), ("nan", None), (" 7 ", 7.0)],
)
def test_to_number(spark, value, number):
    assert one(spark, value, money.to_number) == number


def test_text_rules(spark):
    assert one(spark, "`A`1", text.strip_backticks) == "A1"
    assert one(spark, " 098765432109 ", text.international_phone) == "+918765432109"
    assert one(spark, "K-1_RS_2", text.first_part) == "K-1"
    assert one(spark, " 0071 ", text.numeric_key) == "71"
    assert one(spark, "x", lambda c: text.pair_key(c, F.lit(None).cast("string"))) is None
    assert one(spark, None, lambda c: text.one_of(c, ["a"])) is False
    assert one(spark, None, lambda c: text.contains_any_case(c, "a")) is False


def test_render_sentinels(spark):
    df = spark.createDataFrame(
        [(1.5, None, "x"), (None, "no_cost_avl", "y"), (None, None, "z")],
        "v double, v_reason string, other_reason string",
    )
    shown = sentinels.render_sentinels(df)
    assert shown.columns == ["v", "other_reason"]
    assert [r["v"] for r in shown.collect()] == ["1.5", "no_cost_avl", None]
