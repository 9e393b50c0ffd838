"""Calendar periods as column expressions: bounds, labels and adjacency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from membertide.schemas import ALLTIME, COMPAT, MONTHLY, STRICT, WEEKLY, YEARLY

_TRUNC_UNIT = {WEEKLY: "week", MONTHLY: "month", YEARLY: "year"}


def _unknown(period_type: str) -> ValueError:
    return ValueError(f"unknown period type {period_type!r}")


def period_start(day: Column, period_type: str) -> Column:
    """First day (DATE) of the week (Monday based), month or year that holds ``day``."""
    if period_type not in _TRUNC_UNIT:
        raise _unknown(period_type)
    return F.trunc(day, _TRUNC_UNIT[period_type])


def period_end(start: Column, period_type: str) -> Column:
    """Last day (DATE) of the period that begins on ``start``."""
    if period_type == WEEKLY:
        return F.date_add(start, 6)
    if period_type == MONTHLY:
        return F.last_day(start)
    if period_type == YEARLY:
        return F.make_date(F.year(start), F.lit(12), F.lit(31))
    raise _unknown(period_type)


def range_label(start: Column, end: Column) -> Column:
    """``YYYY-MM-DD/YYYY-MM-DD``, the form of all-time and weekly labels."""
    return F.concat(_iso(start), F.lit("/"), _iso(end))


def period_label(start: Column, period_type: str) -> Column:
    """Text label of the period that begins on ``start``."""
    if period_type == WEEKLY:
        return range_label(start, period_end(start, WEEKLY))
    if period_type == MONTHLY:
        return F.substring(_iso(start), 1, 7)
    if period_type == YEARLY:
        return F.substring(_iso(start), 1, 4)
    raise _unknown(period_type)


def label_bounds(label: Column, period_type: str) -> tuple[Column, Column]:
    """Start and end DATE of a label; a label that does not parse gives NULLs."""
    if period_type in (ALLTIME, WEEKLY):
        return _parse(F.split_part(label, F.lit("/"), F.lit(1))), _parse(
            F.split_part(label, F.lit("/"), F.lit(2))
        )
    if period_type == MONTHLY:
        start = _parse(F.concat(label, F.lit("-01")))
        return start, period_end(start, MONTHLY)
    if period_type == YEARLY:
        start = _parse(F.concat(label, F.lit("-01-01")))
        return start, period_end(start, YEARLY)
    raise _unknown(period_type)


def follows(previous: str, current: str, period_type: str, adjacency: str = COMPAT) -> Column:
    """Whether the period ending on ``current`` comes right after the one ending on ``previous``.

    Both name a DATE column. ``compat`` looks at a single component of the calendar difference
    (years, months, days): seven days for weeks, one month for months, one year for years. A gap
    of one month and seven days hence counts as a week, and one of thirteen months as a month.
    ``strict`` asks for the very next period. NULL or descending dates are never adjacent.
    """
    if period_type not in _TRUNC_UNIT:
        raise _unknown(period_type)
    if adjacency == STRICT:
        test = _strictly_next(previous, current, period_type)
    elif adjacency == COMPAT:
        test = _component_is_one(previous, current, period_type)
    else:
        raise ValueError(f"unknown adjacency {adjacency!r}")
    return F.expr(f"coalesce({current} >= {previous} AND {test}, false)")


def _strictly_next(previous: str, current: str, period_type: str) -> str:
    if period_type == WEEKLY:
        return f"datediff({current}, {previous}) = 7"
    if period_type == MONTHLY:
        return f"{_month_number(current)} - {_month_number(previous)} = 1"
    return f"year({current}) - year({previous}) = 1"


def _component_is_one(previous: str, current: str, period_type: str) -> str:
    # Whole months between the dates: the difference in month numbers, less one if it overshoots.
    by_number = f"({_month_number(current)} - {_month_number(previous)})"
    months = f"({by_number} - CASE WHEN add_months({previous}, {by_number}) > {current} THEN 1 ELSE 0 END)"
    if period_type == WEEKLY:
        return f"datediff({current}, add_months({previous}, {months})) = 7"
    if period_type == MONTHLY:
        return f"{months} % 12 = 1"
    return f"{months} div 12 = 1"


def _month_number(day: str) -> str:
    return f"(12 * year({day}) + month({day}))"


def _iso(day: Column) -> Column:
    return day.cast("date").cast("string")


def _parse(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")
