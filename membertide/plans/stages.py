"""The batch, stage by stage. Each stage reads the tables the one before wrote below ``root``.

``root`` is a folder that all executors share. A stage replaces its own output, so a failed run
is taken up again at the stage that failed. Serving tables are versions: all tables of one are
written, then it is published, and a published version is never written again. The interactions
are read by ``activity`` alone.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from membertide import schemas
from membertide.functions.periods import period_label, range_label
from membertide.operators import charts as charting
from membertide.operators import serving
from membertide.operators.activity import activity_summary, last_organization, with_alltime, with_org_totals
from membertide.operators.cleaning import clean_interactions, clean_therapists
from membertide.operators.history import sort_by_period, with_bounds, with_previous
from membertide.operators.rating import with_rates
from membertide.operators.totals import Totals, count_totals, total_all, total_per_org
from membertide.plans.jobs import together
from membertide.plans.kpis import therapist_input
from membertide.schemas import (
    ALLTIME,
    APP,
    CALENDAR_PERIODS,
    COMPAT,
    ORG,
    RATE_KEYS,
    RATE_VARIANTS,
    TOTAL_KEYS,
    TOTAL_VARIANTS,
)
from membertide.sources import readers, writers

STAGES = ("totals", "activity", "history", "rates", "serve", "charts")


def totals(therapists: DataFrame, root: str) -> None:
    """Total therapists, of the application and per organization."""
    counted = count_totals(clean_therapists(therapists))
    tables = (total_all(counted), f"{root}/num_of_ther/all"), (total_per_org(counted), f"{root}/num_of_ther/per-org")
    together(therapists.sparkSession, [partial(writers.write_tsv, *table) for table in tables])


def _totals(spark: SparkSession, root: str) -> Totals:
    return readers.read_totals(spark, f"{root}/num_of_ther/all", f"{root}/num_of_ther/per-org")


def activity(spark: SparkSession, interactions: DataFrame, root: str) -> None:
    """Active, inactive and total therapists of all seven variants from one pass."""
    _write_active(spark, last_organization(clean_interactions(interactions)), root)


def activity_with_inputs(
    spark: SparkSession, interactions: DataFrame, therapists: DataFrame, root: str, files: int | None = None
) -> None:
    """As ``activity``, and export the rows that were counted, in ``files`` part files each.

    These rows are one per therapist and period. They are written as a table first, which the
    exports and the counts then share.
    """
    path = f"{root}/last_organization"
    last_organization(clean_interactions(interactions)).write.mode("overwrite").partitionBy("period_type").parquet(path)
    last = spark.read.parquet(path)
    _write_active(spark, last, root)

    totals_read = _totals(spark, root)

    def write_inputs(level: str, period_type: str) -> None:
        rows = last.filter(F.col("period_type") == period_type)
        if period_type != ALLTIME:
            rows = rows.withColumn("period", period_label(F.col("period_start"), period_type))
        rows = with_org_totals(rows, totals_read) if level == ORG else with_alltime(rows, totals_read)
        writers.write_delimited(
            rows.select(*schemas.INTERACTION_INPUT[level, period_type].names),
            writers.stage_path(root, "interaction_input", level, period_type),
            files=files,
        )

    joined = partial(writers.write_delimited, therapist_input(therapists), f"{root}/therapist_input", files=files)
    together(spark, [joined, *(partial(write_inputs, *variant) for variant in TOTAL_VARIANTS)])


def _write_active(spark: SparkSession, last: DataFrame, root: str) -> None:
    path = f"{root}/activity"
    summary = activity_summary(last, _totals(spark, root))
    summary.write.mode("overwrite").partitionBy("level", "period_type").parquet(path)
    figures = spark.read.parquet(path)
    start, end = F.col("period_start"), F.col("period_end")

    def write(level: str, period_type: str) -> None:
        label = range_label(start, end) if period_type == ALLTIME else period_label(start, period_type)
        variant = figures.filter((F.col("level") == level) & (F.col("period_type") == period_type))
        writers.write_tsv(
            variant.withColumn("period", label).select(*schemas.active(level).names),
            writers.stage_path(root, "active_ther", level, period_type),
        )

    together(spark, [partial(write, *variant) for variant in TOTAL_VARIANTS])


def _active(spark: SparkSession, root: str, level: str, period_type: str) -> DataFrame:
    active = readers.read_active(spark, writers.stage_path(root, "active_ther", level, period_type), level)
    return with_bounds(active, period_type)


def history(spark: SparkSession, root: str, adjacency: str = COMPAT) -> None:
    """Add the figures of the period before, in the order of the periods."""

    def write(level: str, period_type: str) -> None:
        enriched = sort_by_period(with_previous(_active(spark, root, level, period_type), period_type, adjacency))
        writers.write_delimited(
            enriched.select(*schemas.rate_input(level).names),
            writers.stage_path(root, "rate_input", level, period_type),
        )

    together(spark, [partial(write, *variant) for variant in RATE_VARIANTS])


def rates(spark: SparkSession, root: str) -> None:
    """Churn and retention."""

    def write(level: str, period_type: str) -> None:
        path = writers.stage_path(root, "rate_input", level, period_type)
        rated = with_rates(readers.read_rate_input(spark, path, level))
        writers.write_delimited(
            rated.select(*schemas.rate_output(level).names),
            writers.stage_path(root, "rate_output", level, period_type),
        )

    together(spark, [partial(write, *variant) for variant in RATE_VARIANTS])


def serve(
    spark: SparkSession, root: str, version: str, previous: str | None = None, fresh: bool = False
) -> None:
    """Upsert all records into the serving tables, from version ``previous`` to ``version``.

    Without ``previous`` the tables hold this run's records alone; beside published versions
    that has to be asked for by ``fresh``.
    """
    known = writers.published(spark, f"{root}/serving")
    if version in known:
        raise ValueError(f"version {version!r} is published and stays as it is")
    if previous is not None and previous not in known:
        raise ValueError(f"version {previous!r} is not published")
    if previous is None and known and not fresh:
        raise ValueError("there are published versions; name one as previous, or ask for a fresh table")
    total_feeds = [serving.total_records(_active(spark, root, lv, p), p) for lv, p in TOTAL_VARIANTS]
    rate_feeds = [
        serving.rate_records(
            readers.read_rate_output(spark, writers.stage_path(root, "rate_output", lv, p), lv), p
        )
        for lv, p in RATE_VARIANTS
    ]

    def write(name: str, feeds: list[DataFrame], keys: tuple[str, ...]) -> None:
        current = serving_path(root, name, previous) if previous else None
        writers.write_version(spark, current, serving.union_feeds(feeds), keys, serving_path(root, name, version))

    together(spark, [partial(write, "totals", total_feeds, TOTAL_KEYS), partial(write, "rates", rate_feeds, RATE_KEYS)])
    writers.publish(spark, f"{root}/serving", version)


def serving_path(root: str, name: str, version: str) -> str:
    return f"{root}/serving/{name}/{version}"


def charts(spark: SparkSession, root: str, version: str) -> None:
    """Export the serving tables, and the bars of every chart.

    Bars show the application's own records. Those lie in files of their own and are few, so no chart
    reads the organizations' records.
    """
    if version not in writers.published(spark, f"{root}/serving"):
        raise ValueError(f"version {version!r} is not published")
    tables = []
    for name, to_export in (("totals", charting.totals_export), ("rates", charting.rates_export)):
        path = serving_path(root, name, version)
        tables.append((to_export(writers.read_version(spark, path)), f"{root}/export/{name}"))
        export = to_export(writers.read_version(spark, path, APP))
        for period_type in CALENDAR_PERIODS:
            tables.append((charting.bars(export, period_type), f"{root}/charts/{name}/{period_type}"))
            tables.append((charting.year_range(export, period_type), f"{root}/charts/{name}-years/{period_type}"))
    together(spark, [partial(writers.write_export, *table) for table in tables])


def run_all(
    spark: SparkSession,
    interactions: DataFrame,
    therapists: DataFrame,
    root: str,
    version: str,
    *,
    previous: str | None = None,
    fresh: bool = False,
    adjacency: str = COMPAT,
    export_inputs: bool = False,
    files: int | None = None,
    only: tuple[str, ...] = STAGES,
) -> None:
    """Run the stages named by ``only``, in order."""
    if unknown := set(only) - set(STAGES):
        raise ValueError(f"unknown stages {sorted(unknown)}")
    if "totals" in only:
        totals(therapists, root)
    if "activity" in only and export_inputs:
        activity_with_inputs(spark, interactions, therapists, root, files)
    elif "activity" in only:
        activity(spark, interactions, root)
    if "history" in only:
        history(spark, root, adjacency)
    if "rates" in only:
        rates(spark, root)
    if "serve" in only:
        serve(spark, root, version, previous, fresh)
    if "charts" in only:
        charts(spark, root, version)
