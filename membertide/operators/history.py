"""Figures of the period before, through a calendar-aware lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from membertide.functions.periods import follows, label_bounds
from membertide.schemas import CALENDAR_PERIODS, COMPAT


def with_bounds(active: DataFrame, period_type: str) -> DataFrame:
    """Replace the ``period`` label, as read from a file, by ``period_start`` and ``period_end``."""
    start, end = label_bounds(F.col("period"), period_type)
    rest = [c for c in active.columns if c not in ("period", "period_start", "period_end")]
    return active.select(start.alias("period_start"), end.alias("period_end"), *rest)


def sort_by_period(df: DataFrame) -> DataFrame:
    """Ascending by period, unknown dates last.

    Organizations break ties, so that a sort over few periods can still be split into many
    ranges.
    """
    ties = ["organization_id"] if "organization_id" in df.columns else []
    return df.orderBy(F.col("period_start").asc_nulls_last(), F.col("period_end").asc_nulls_last(), *ties)


def with_previous(active: DataFrame, period_type: str | None = None, adjacency: str = COMPAT) -> DataFrame:
    """Add ``active_ther_b_period`` and ``inactive_ther_b_period``.

    Both are 0 on the first row of a series and where the row before is not the calendar
    predecessor. A series is an organization, or the application where there is none; without
    ``period_type`` the frame holds several types in a column of that name, each its own series.

    The window runs on aggregated rows: a series has at most one row per calendar period, so
    its length depends on the calendar, not on the number of interactions or therapists.
    """
    series = [c for c in ("period_type", "organization_id") if c in active.columns]
    window = Window.partitionBy(*series).orderBy(
        F.col("period_start").asc_nulls_last(), F.col("period_end").asc_nulls_last()
    )
    # The lags become columns of their own first, so that the window computes each one once.
    lagged = active.withColumns(
        {f"previous_{c}": F.lag(c).over(window) for c in ("period_end", "active_ther", "inactive_ther")}
    )
    adjacent = _adjacent(period_type, adjacency)
    before = {
        f"{c}_b_period": F.when(adjacent, F.col(f"previous_{c}")).otherwise(F.lit(0).cast("bigint"))
        for c in ("active_ther", "inactive_ther")
    }
    return lagged.withColumns(before).select(*active.columns, *before)


def _adjacent(period_type: str | None, adjacency: str) -> Column:
    if period_type is not None:
        return follows("previous_period_end", "period_end", period_type, adjacency)
    of_type = F.lit(False)
    for name in CALENDAR_PERIODS:
        test = follows("previous_period_end", "period_end", name, adjacency)
        of_type = F.when(F.col("period_type") == name, test).otherwise(of_type)
    return of_type
