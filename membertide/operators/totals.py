"""Total therapists and the all-time period."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membertide.functions.periods import range_label


@dataclass(frozen=True)
class Totals:
    """What activity is measured against, counted from therapists or read from files.

    ``alltime`` has at most one row: ``period_start, period_end, total_ther, all_time_period``.
    ``sizes`` has ``organization_id, total_ther``. The number of organizations grows with the
    data, so joins with ``sizes`` carry no broadcast hint: Spark compares its size with
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges.
    """

    alltime: DataFrame
    sizes: DataFrame

    def scalar(self) -> Column:
        """The row of ``alltime`` as a struct-valued scalar subquery.

        Spark runs the subquery once and hands its value to the tasks; no join is involved.
        """
        return self.alltime.select(F.struct(*self.alltime.columns).alias("alltime")).scalar()


def alltime_period(therapists: DataFrame) -> DataFrame:
    """One row: first and last join date, the number of rows and the label between the dates.

    Totals count rows, not distinct ids. No therapists at all give no row.
    """
    first, last = F.min("date_joined").cast("date"), F.max("date_joined").cast("date")
    return _labelled(therapists.agg(first.alias("period_start"), last.alias("period_end"), F.count("*").alias("total_ther")))


def _labelled(alltime: DataFrame) -> DataFrame:
    counted = alltime.filter(F.col("total_ther") > 0)
    return counted.withColumn("all_time_period", range_label(F.col("period_start"), F.col("period_end")))


def count_totals(therapists: DataFrame) -> Totals:
    """Both figures from one scan: per organization first, and all time out of the organizations.

    Spark shares the aggregate only if both ask for the same columns, so the sizes look at the dates
    as well, by a test that always holds: the first date is never after the last.
    """
    dates = F.min("date_joined").alias("first_joined"), F.max("date_joined").alias("last_joined")
    per_org = therapists.groupBy("organization_id").agg(F.count("*").alias("total_ther"), *dates)
    per_org = per_org.filter(F.coalesce(F.col("first_joined") <= F.col("last_joined"), F.lit(True)))
    first, last = F.min("first_joined").cast("date"), F.max("last_joined").cast("date")
    alltime = per_org.agg(first.alias("period_start"), last.alias("period_end"), F.sum("total_ther").alias("total_ther"))
    return Totals(_labelled(alltime), per_org.select("organization_id", "total_ther"))


def total_all(totals: Totals) -> DataFrame:
    return totals.alltime.select(
        F.col("all_time_period").alias("period"), F.col("total_ther").alias("total")
    )


def total_per_org(totals: Totals) -> DataFrame:
    return totals.sizes.select(
        totals.scalar()["all_time_period"].alias("period"),
        "organization_id",
        F.col("total_ther").alias("total"),
    )
