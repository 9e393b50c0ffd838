from __future__ import annotations

import math

import pytest

from membertide.functions.rates import churn_rate, retention_rate


def _expected(before, within):
    if before == 0:
        return 0.0, 0.0
    return round((before - within) / before, 2), round(within / before, 2)


def test_rates_agree_with_binary_rounding_everywhere(spark):
    pairs = spark.range(0, 401).selectExpr("id AS b").selectExpr("b", "explode(sequence(0L, 2L * b + 3L)) AS w")
    found = pairs.select("b", "w", churn_rate("b", "w").alias("c"), retention_rate("b", "w").alias("r")).collect()
    assert len(found) > 160_000
    wrong = [(b, w, c, r) for b, w, c, r in found if (c, r) != _expected(b, w)]
    assert not wrong


def test_ties_of_large_counts(spark):
    """Every quotient here is an exact decimal tie, where only the binary error decides."""
    pairs = spark.range(1, 20_000).selectExpr("200000L AS b", "id * 1000L + 500000L AS w") \
        .unionAll(spark.range(0, 20_000).selectExpr("1000L AS b", "id * 10L + 5L AS w"))
    found = pairs.select("b", "w", churn_rate("b", "w").alias("c"), retention_rate("b", "w").alias("r")).collect()
    assert not [row for row in found if tuple(row[2:]) != _expected(row[0], row[1])]


@pytest.mark.parametrize(
    "before, within, churn, retention",
    [(0, 3, 0.0, 0.0), (4, 5, -0.25, 1.25), (3, 2, 0.33, 0.67), (8, 1, 0.88, 0.12), (40, 3, 0.93, 0.07)],
)
def test_hand_made_rates(spark, before, within, churn, retention):
    df = spark.createDataFrame([(before, within)], "b BIGINT, w BIGINT")
    assert tuple(df.select(churn_rate("b", "w"), retention_rate("b", "w")).first()) == (churn, retention)


def test_no_negative_zero(spark):
    df = spark.createDataFrame([(1000, 1001)], "b BIGINT, w BIGINT")
    assert math.copysign(1, df.select(churn_rate("b", "w")).first()[0]) == 1
