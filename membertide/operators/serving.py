"""Long-format KPI records, their grouping per organization, and keyed upserts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.schemas import RATE_RECORD, TOTAL_RECORD


def _identified(df: DataFrame, period_type: str | None) -> DataFrame:
    """Name the record's identity; application rows get a NULL organization."""
    if "organization_id" not in df.columns:
        df = df.withColumn("organization_id", F.lit(None).cast("bigint"))
    if period_type is not None:
        df = df.withColumn("period_type", F.lit(period_type))
    return df.withColumnsRenamed({"period_start": "start_date", "period_end": "end_date"})


_IDENTITY = ["organization_id", "period_type", "start_date", "end_date"]


def total_records(active: DataFrame, period_type: str | None = None) -> DataFrame:
    """Two records per row: the active value and the inactive value."""
    long = _identified(active, period_type).unpivot(
        _IDENTITY, ["active_ther", "inactive_ther"], "measure", "value"
    )
    return long.withColumn("is_active", F.col("measure") == "active_ther").select(*TOTAL_RECORD.names)


def rate_records(rates: DataFrame, period_type: str | None = None) -> DataFrame:
    """Two records per row: ``churn_rate`` and ``retention_rate``."""
    long = _identified(rates, period_type).unpivot(_IDENTITY, ["churn_rate", "retention_rate"], "type", "value")
    return long.select(*RATE_RECORD.names)


def union_feeds(feeds: Iterable[DataFrame]) -> DataFrame:
    """One serving table out of the feeds of all levels and period types."""
    return reduce(DataFrame.unionByName, feeds)


def records_by_org(records: DataFrame) -> DataFrame:
    """``organization_id, records``: each organization's records in calendar order.

    Per date, active comes before inactive and churn before retention. A list has two records
    per calendar period and type, so its length is bounded by the calendar.
    """
    payload = [c for c in records.columns if c != "organization_id"]
    order = ~F.col("is_active") if "is_active" in payload else F.col("type")
    sortable = F.struct(
        "start_date", "end_date", "period_type", order.alias("rank"), F.struct(*payload).alias("record")
    )
    in_order = F.sort_array(F.collect_list(sortable))
    return (
        records.filter(F.col("organization_id").isNotNull())
        .groupBy("organization_id")
        .agg(in_order.getField("record").alias("records"))
    )


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` created or, where the keys match, replaced.

    NULL keys match each other. ``updates`` holds each key once. The join is an equi-join
    without a hint: Spark broadcasts ``updates`` when it is small and leaves ``target``
    unshuffled, or sort-merges both.
    """
    t, u = target.alias("t"), updates.select(*keys).alias("u")
    same = reduce(lambda a, b: a & b, (F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys))
    return t.join(u, same, "left_anti").unionByName(updates.select(*target.columns))
