"""Chart-ready figures of the application, from the serving tables' exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.functions.periods import period_label, period_start
from membertide.schemas import YEARLY


def totals_export(records: DataFrame) -> DataFrame:
    """Serving totals in export form, where ``type`` is 'active' or 'inactive'."""
    kind = F.when(F.col("is_active"), F.lit("active")).otherwise(F.lit("inactive"))
    return records.select("organization_id", kind.alias("type"), "period_type", "start_date", "end_date", "value")


def rates_export(records: DataFrame) -> DataFrame:
    return records.select("organization_id", "type", "period_type", "start_date", "end_date", "value")


def app_rows(export: DataFrame, period_type: str) -> DataFrame:
    """The application's own rows of one period type, with their ``period`` label."""
    start = F.col("start_date")
    return export.filter(F.col("organization_id").isNull() & (F.col("period_type") == period_type)).withColumn(
        "period", period_label(period_start(start, period_type), period_type)
    )


def year_range(export: DataFrame, period_type: str) -> DataFrame:
    """One row: the first year, and the year after the last, that charts go over."""
    return app_rows(export, period_type).agg(
        F.year(F.min("start_date")).alias("min_year"), (F.year(F.max("end_date")) + 1).alias("max_year")
    )


def bars(export: DataFrame, period_type: str) -> DataFrame:
    """Mean value per bar: ``chart_year, period, type, value``.

    Weekly and monthly charts are cut by calendar year and show only periods that lie within
    one, so a week across New Year is in none. There is a single yearly chart and hence no
    ``chart_year``; ``year_range`` gives the years of its title.
    """
    rows, chart = app_rows(export, period_type), []
    if period_type != YEARLY:
        rows = rows.filter(F.year("start_date") == F.year("end_date")).withColumn("chart_year", F.year("start_date"))
        chart = ["chart_year"]
    return rows.groupBy(*chart, "period", "type").agg(F.avg("value").alias("value"))
