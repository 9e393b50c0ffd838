"""Active, inactive and total therapists per period, for the application or per organization."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.functions.periods import period_end, period_label, period_start
from membertide.operators.dedup import dedup_alltime, dedup_period
from membertide.operators.totals import Totals
from membertide.schemas import ALLTIME, APP, CALENDAR_PERIODS, MONTHLY, ORG, WEEKLY, check_variant


def with_alltime(interactions: DataFrame, totals: Totals) -> DataFrame:
    """Attach the all-time label and total as ``all_time_period`` and ``all_time_thers``."""
    alltime = totals.scalar()
    return interactions.withColumns(
        {"all_time_period": alltime["all_time_period"], "all_time_thers": alltime["total_ther"]}
    )


def with_org_totals(interactions: DataFrame, totals: Totals) -> DataFrame:
    """Left join with the size of each row's organization as ``total_thers_in_org``.

    There is one build row per organization, so Spark's size check sees what a broadcast would
    send. Should the sizes be too many, both sides are shuffled, and one organization may hold
    a large share of the rows. The join key is an expression: a plain column would reuse the
    partitioning that counted the sizes, and adaptive execution splits a skewed
    partition only below an exchange that belongs to the join.
    """
    key = F.col("organization_id").cast("decimal(20,0)")
    sizes = totals.sizes.select(key.alias("size_of"), F.col("total_ther").alias("total_thers_in_org"))
    keyed = interactions.withColumn("size_key", key)
    return keyed.join(sizes, F.col("size_key") == F.col("size_of"), "left").drop("size_key", "size_of")


def active_therapists(interactions: DataFrame, totals: Totals, level: str, period_type: str) -> DataFrame:
    """One variant: ``period, period_start, period_end, [organization_id], active, inactive, total``.

    A therapist counts once per period, under the organization of the last interaction in it.
    Totals are those of all time whatever the period, so inactive can fall below zero. An
    organization without therapists has NULL total and inactive. Periods without activity
    have no row.
    """
    check_variant(level, period_type)
    if period_type == ALLTIME:
        return _active_alltime(interactions, totals)

    last = dedup_period(interactions, period_type)
    if level == APP:
        counted = last.groupBy("period_start").agg(F.count("*").alias("active_ther"))
        counted = counted.withColumn("total_ther", totals.scalar()["total_ther"])
    else:
        counted = last.groupBy("period_start", "organization_id").agg(F.count("*").alias("active_ther"))
        counted = counted.join(totals.sizes, "organization_id", "left")

    start = F.col("period_start")
    return counted.select(
        period_label(start, period_type).alias("period"),
        start,
        period_end(start, period_type).alias("period_end"),
        *(["organization_id"] if level == ORG else []),
        "active_ther",
        (F.col("total_ther") - F.col("active_ther")).alias("inactive_ther"),
        "total_ther",
    )


def _active_alltime(interactions: DataFrame, totals: Totals) -> DataFrame:
    alltime = totals.scalar()
    counted = dedup_alltime(interactions).agg(F.count("*").alias("active_ther"))
    return counted.filter(F.col("active_ther") > 0).select(
        alltime["all_time_period"].alias("period"),
        alltime["period_start"].alias("period_start"),
        alltime["period_end"].alias("period_end"),
        "active_ther",
        (alltime["total_ther"] - F.col("active_ther")).alias("inactive_ther"),
        alltime["total_ther"].alias("total_ther"),
    )


def last_organization(interactions: DataFrame) -> DataFrame:
    """Every period type at once: ``therapist_id, period_type, period_start, organization_id``.

    The interactions are read once and combined on the map side down to one row per therapist
    and *cell*: the part of a week that lies within one month, named by its first day. Cells
    nest in weeks, months, years and all time, and keeping the last row can be repeated, so
    the periods are rolled up from cells. Cells move to their therapist's partition before
    each turns into four rows; a therapist has no more cells than the calendar, however many
    interactions, and the rows of a generator stay where they are, so the roll-up itself needs
    no shuffle. All-time rows have no start.
    """
    return last_rows(interactions).drop("seq")


def last_rows(interactions: DataFrame) -> DataFrame:
    """``last_organization`` with the ``seq`` of the row that counts, so that results can be merged."""
    day = F.col("interaction_date")
    cell = F.greatest(period_start(day, WEEKLY), period_start(day, MONTHLY))
    cells = (
        interactions.select("therapist_id", cell.alias("cell"), "organization_id", "seq")
        .groupBy("therapist_id", "cell")
        .agg(F.max_by("organization_id", "seq").alias("organization_id"), F.max("seq").alias("seq"))
        .repartition("therapist_id")
    )
    starts = [
        column
        for period_type in CALENDAR_PERIODS
        for column in (F.lit(period_type), period_start(F.col("cell"), period_type))
    ]
    periods = cells.select(
        "therapist_id",
        "organization_id",
        "seq",
        F.stack(F.lit(4), *starts, F.lit(ALLTIME), F.lit(None).cast("date")).alias("period_type", "period_start"),
    )
    return merged_rows(periods.filter((F.col("period_type") == ALLTIME) | F.col("period_start").isNotNull()))


def merged_rows(rows: DataFrame) -> DataFrame:
    """The row of the highest ``seq`` per therapist and period; keeping the last may be repeated in any order."""
    return rows.groupBy("therapist_id", "period_type", "period_start").agg(
        F.max_by("organization_id", "seq").alias("organization_id"), F.max("seq").alias("seq")
    )


def period_counts(last: DataFrame) -> DataFrame:
    """Active therapists per period and organization from ``last_organization``."""
    return last.groupBy("period_type", "period_start", "organization_id").agg(F.count("*").alias("n"))


def activity_summary(last: DataFrame, totals: Totals) -> DataFrame:
    """All seven variants in one frame from ``last_organization``.

    ``level, period_type, organization_id, period_start, period_end, active, inactive, total``;
    the application's rows have a NULL organization. A therapist is under one organization per
    period, so application counts are sums of organization counts and no second count of
    therapists is needed.
    """
    return counts_summary(period_counts(last), totals)


def counts_summary(per_org: DataFrame, totals: Totals) -> DataFrame:
    """``activity_summary`` from ``period_counts``."""
    alltime = totals.scalar()
    counted = (
        per_org.groupingSets(
            [["period_type", "period_start", "organization_id"], ["period_type", "period_start"]],
            "period_type",
            "period_start",
            "organization_id",
        )
        .agg(F.grouping("organization_id").alias("is_app"), F.sum("n").alias("active_ther"))
        .filter((F.col("is_app") == 1) | (F.col("period_type") != ALLTIME))
        .join(totals.sizes, "organization_id", "left")
    )
    is_app = F.col("is_app") == 1
    is_alltime = F.col("period_type") == ALLTIME
    total = F.when(is_app, alltime["total_ther"]).otherwise(F.col("total_ther"))
    end = F.when(is_alltime, alltime["period_end"])
    for period_type in CALENDAR_PERIODS:
        end = end.when(F.col("period_type") == period_type, period_end(F.col("period_start"), period_type))
    return counted.select(
        F.when(is_app, F.lit(APP)).otherwise(F.lit(ORG)).alias("level"),
        "period_type",
        "organization_id",
        F.when(is_alltime, alltime["period_start"]).otherwise(F.col("period_start")).alias("period_start"),
        end.alias("period_end"),
        "active_ther",
        (total - F.col("active_ther")).alias("inactive_ther"),
        total.alias("total_ther"),
    )
