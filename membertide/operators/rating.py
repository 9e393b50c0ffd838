"""Churn and retention columns on top of the before-period figures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from membertide.functions.rates import churn_rate, retention_rate


def with_rates(rate_input: DataFrame) -> DataFrame:
    before, within = "active_ther_b_period", "active_ther"
    return rate_input.withColumns(
        {"churn_rate": churn_rate(before, within), "retention_rate": retention_rate(before, within)}
    )
