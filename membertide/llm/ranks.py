"""Ranks of rows within groups, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import Scratch, partitions, small


def ranked(rows: DataFrame, group: list[str], order: list[Column], scratch: Scratch) -> DataFrame:
    """``rows`` with ``position`` (from 0 within the group, by ``order``) and ``total``, the group's rows.

    The rows are dealt by ranges of group and order, so a hot group is spread over many tasks, and
    written; a row's position is its place in its range plus the group's rows in the ranges before,
    of which there is one count per range and group. Groups must not be null.
    """
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *group, *order).sortWithinPartitions(*group, *order)
    placed = scratch.table(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", 33).alias("__part")
    counts = placed.groupBy(*group, part).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    over = ", ".join(f"`{c}`" for c in group) or "1"
    starts = counts.selectExpr(
        *[f"`{c}`" for c in group], "__part", "__first",
        f"sum(__n) OVER (PARTITION BY {over} ORDER BY __part) - __n AS __before", f"sum(__n) OVER (PARTITION BY {over}) AS total",
    )
    starts = small(scratch.table(starts, "starts"), 64)
    joined = placed.withColumn("__part", part).join(starts, [*group, "__part"])
    return joined.withColumn("position", F.col("__before") + F.col("__at") - F.col("__first")).drop("__at", "__part", "__first", "__before", "__n")
