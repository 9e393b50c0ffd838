"""Key figures from the two source tables, up to serving records and chart bars.

Each function takes the raw source frames and returns a lazy frame, so a result is a single
Spark plan. ``membertide.plans.stages`` runs the same steps as a batch from files to files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide import schemas
from membertide.operators import activity, charts, serving
from membertide.operators.cleaning import clean_interactions, clean_therapists
from membertide.operators.dedup import dedup_alltime, dedup_period
from membertide.operators.history import with_previous
from membertide.operators.rating import with_rates
from membertide.operators.totals import count_totals
from membertide.schemas import ALLTIME, APP, COMPAT, ORG, RATE_VARIANTS


def therapist_input(therapists: DataFrame) -> DataFrame:
    """Every counted therapist with the all-time label."""
    members = clean_therapists(therapists)
    label = count_totals(members).scalar()["all_time_period"]
    return members.select(label.alias("all_time_period"), "organization_id", "id")


def interaction_input(interactions: DataFrame, therapists: DataFrame, level: str, period_type: str) -> DataFrame:
    """One row per counted therapist and period, with the total it is measured against."""
    schemas.check_variant(level, period_type)
    rows, totals = clean_interactions(interactions), count_totals(clean_therapists(therapists))
    last = dedup_alltime(rows) if period_type == ALLTIME else dedup_period(rows, period_type)
    if level == ORG:
        last = activity.with_org_totals(last, totals)
    else:
        last = activity.with_alltime(last, totals)
    return last.select(*schemas.INTERACTION_INPUT[level, period_type].names)


def active(interactions: DataFrame, therapists: DataFrame, level: str, period_type: str) -> DataFrame:
    figures = _active(interactions, therapists, level, period_type)
    return figures.select(*schemas.active(level).names)


def _active(interactions: DataFrame, therapists: DataFrame, level: str, period_type: str) -> DataFrame:
    totals = count_totals(clean_therapists(therapists))
    return activity.active_therapists(clean_interactions(interactions), totals, level, period_type)


def rate_input(
    interactions: DataFrame, therapists: DataFrame, level: str, period_type: str, adjacency: str = COMPAT
) -> DataFrame:
    schemas.check_variant(level, period_type, RATE_VARIANTS)
    figures = with_previous(_active(interactions, therapists, level, period_type), period_type, adjacency)
    return figures.select(*schemas.rate_input(level).names)


def rates(
    interactions: DataFrame, therapists: DataFrame, level: str, period_type: str, adjacency: str = COMPAT
) -> DataFrame:
    figures = with_rates(rate_input(interactions, therapists, level, period_type, adjacency))
    return figures.select(*schemas.rate_output(level).names)


def total_feed(interactions: DataFrame, therapists: DataFrame, level: str, period_type: str) -> DataFrame:
    return serving.total_records(_active(interactions, therapists, level, period_type), period_type)


def rate_feed(
    interactions: DataFrame, therapists: DataFrame, level: str, period_type: str, adjacency: str = COMPAT
) -> DataFrame:
    return serving.rate_records(rates(interactions, therapists, level, period_type, adjacency), period_type)


def summary(interactions: DataFrame, therapists: DataFrame) -> DataFrame:
    """All seven variants out of one pass over the interactions."""
    last = activity.last_organization(clean_interactions(interactions))
    return activity.activity_summary(last, count_totals(clean_therapists(therapists)))


def summary_rates(figures: DataFrame, adjacency: str = COMPAT) -> DataFrame:
    """Rates of all variants that have them, from ``summary``."""
    return with_rates(with_previous(figures.filter(F.col("period_type") != ALLTIME), adjacency=adjacency))


def serving_totals(interactions: DataFrame, therapists: DataFrame) -> DataFrame:
    """All total records. Equal to the union of the seven feeds, without reading seven times."""
    return serving.total_records(summary(interactions, therapists))


def serving_rates(interactions: DataFrame, therapists: DataFrame, adjacency: str = COMPAT) -> DataFrame:
    """All rate records, likewise from one pass."""
    return serving.rate_records(summary_rates(summary(interactions, therapists), adjacency))


def chart_totals(interactions: DataFrame, therapists: DataFrame, period_type: str) -> DataFrame:
    """Bars of one period type straight from the source tables, computing that variant alone."""
    feed = total_feed(interactions, therapists, APP, period_type)
    return charts.bars(charts.totals_export(feed), period_type)


def chart_rates(
    interactions: DataFrame, therapists: DataFrame, period_type: str, adjacency: str = COMPAT
) -> DataFrame:
    feed = rate_feed(interactions, therapists, APP, period_type, adjacency)
    return charts.bars(charts.rates_export(feed), period_type)
