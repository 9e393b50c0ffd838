from __future__ import annotations

from datetime import date, timedelta

import pandas as pd
import pytest
from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from membertide.functions.periods import follows, label_bounds, period_end, period_label, period_start
from membertide.schemas import CALENDAR_PERIODS, COMPAT, STRICT

PANDAS = {"weekly": "W", "monthly": "M", "yearly": "Y"}
DAYS = [date(1995, 1, 1) + timedelta(days=n) for n in range(0, 3000, 1)] + [date(2000, 2, 29), date(2024, 12, 30)]


@pytest.mark.parametrize("period_type", CALENDAR_PERIODS)
def test_labels_and_bounds_agree_with_pandas(spark, period_type):
    df = spark.createDataFrame([(d,) for d in DAYS], "d DATE")
    start = period_start(F.col("d"), period_type)
    found = df.select("d", period_label(start, period_type).alias("label"), start.alias("start"),
                      period_end(start, period_type).alias("end"))
    parsed = found.select("d", "label", "start", "end", *(
        c.alias(n) for c, n in zip(label_bounds(F.col("label"), period_type), ("s", "e"))))
    for d, label, start, end, s, e in parsed.collect():
        expected = pd.Timestamp(d).to_period(PANDAS[period_type])
        assert label == str(expected)
        assert (start, end) == (expected.start_time.date(), expected.end_time.date())
        assert (s, e) == (start, end)


@pytest.mark.parametrize(
    "period_type, label", [("weekly", "not a week"), ("weekly", "2021-02-30/x"), ("monthly", "2021-13"), ("yearly", "")]
)
def test_bad_labels_become_null(spark, period_type, label):
    start, end = label_bounds(F.lit(label), period_type)
    assert tuple(spark.range(1).select(start, end).first()) == (None, None)


def _component(period_type, previous, current):
    if current < previous:
        return False
    delta = relativedelta(current, previous)
    return {"weekly": delta.days == 7, "monthly": delta.months == 1, "yearly": delta.years == 1}[period_type]


@pytest.mark.parametrize("period_type", CALENDAR_PERIODS)
def test_compat_adjacency_is_one_component_of_the_calendar_difference(spark, period_type):
    sunday = date(2019, 1, 6)
    ends = {
        "weekly": [sunday + timedelta(weeks=n) for n in range(170)],
        "monthly": [date(2018 + n // 12, n % 12 + 1, 1) + relativedelta(day=31) for n in range(96)],
        "yearly": [date(y, 12, 31) for y in range(1995, 2030)],
    }[period_type]
    pairs = [(a, b) for a in ends for b in ends]
    df = spark.createDataFrame(pairs, "a DATE, b DATE").select("a", "b", follows("a", "b", period_type).alias("is"))
    wrong = [(a, b) for a, b, found in df.collect() if found != _component(period_type, a, b)]
    assert not wrong


@pytest.mark.parametrize(
    "period_type, previous, current, compat, strict",
    [
        ("weekly", "2021-01-10", "2021-01-17", True, True),
        ("weekly", "2021-01-10", "2021-01-24", False, False),
        ("weekly", "2021-02-07", "2021-03-14", True, False),
        ("weekly", "2021-01-17", "2021-01-10", False, False),
        ("monthly", "2021-01-31", "2021-02-28", True, True),
        ("monthly", "2020-01-31", "2020-02-29", True, True),
        ("monthly", "2021-01-31", "2021-03-31", False, False),
        ("monthly", "2020-01-31", "2021-02-28", True, False),
        ("yearly", "2019-12-31", "2020-12-31", True, True),
        ("yearly", "2020-12-31", "2022-12-31", False, False),
        ("yearly", None, "2022-12-31", False, False),
    ],
)
def test_adjacency(spark, period_type, previous, current, compat, strict):
    df = spark.createDataFrame([(previous, current)], "a STRING, b STRING").selectExpr("DATE(a) a", "DATE(b) b")
    found = df.select(follows("a", "b", period_type, COMPAT), follows("a", "b", period_type, STRICT)).first()
    assert tuple(found) == (compat, strict)


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError):
        period_start(F.lit(1), "daily")
    with pytest.raises(ValueError):
        follows("a", "b", "weekly", "loose")
