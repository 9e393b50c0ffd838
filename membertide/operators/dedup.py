"""Keep-last deduplication in row order.

Spark rows have no order, so every frame carries ``seq``: a unique, never-NULL value that
rises in file order. Keeping the row of the highest ``seq`` is an aggregate, combined on the
map side before the shuffle, so a key that holds a large share of all rows costs each map
task one group and never gathers in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.functions.periods import period_label, period_start

SEQ = "seq"


def keep_last(df: DataFrame, keys: Sequence[str], order_by: str = SEQ) -> DataFrame:
    """The row of the highest ``order_by`` for each distinct ``keys``; NULL keys are equal.

    One ``max_by`` per column rather than one over a struct: fixed-width buffers keep Spark on
    hash aggregation, where a struct would make it sort its input. ``order_by`` is unique, so
    every column comes from the same row; columns nobody reads are pruned with their buffers.
    """
    kept = [c for c in df.columns if c not in keys and c != order_by]
    return (
        df.groupBy(*keys)
        .agg(*(F.max_by(c, order_by).alias(c) for c in kept), F.max(order_by).alias(order_by))
        .select(*df.columns)
    )


_HASHES = 1 << 32


def keep_last_told(df: DataFrame, keys: Sequence[str], order_by: str = SEQ, tied: str = "tied") -> DataFrame:
    """``keep_last`` by a BIGINT order that may not be unique, with a column that tells where it was not.

    ``tied`` is true where rows of the highest order differ; whichever was kept, another had the same claim. It takes no
    further shuffle: with each row's hash below its order, once as it is and once reversed, the two greatest
    numbers belong to one row unless the last rows differ. They are of fixed width as well.
    """
    rest = [c for c in df.columns if c not in keys and c != order_by]
    hashed = F.hash(*rest).cast("bigint").bitwiseAND(F.lit(_HASHES - 1)) if rest else F.lit(0)
    order = F.col(order_by).cast("decimal(19,0)") * F.lit(_HASHES).cast("decimal(11,0)")
    numbers = df.withColumns({"__up": order + hashed.cast("decimal(11,0)"), "__down": order + (F.lit(_HASHES - 1) - hashed).cast("decimal(11,0)")})
    kept = numbers.groupBy(*keys).agg(
        *(F.max_by(c, order_by).alias(c) for c in rest), F.max(order_by).alias(order_by), F.max("__up").alias("__up"), F.max("__down").alias("__down")
    )
    alone = F.col(order_by).cast("decimal(19,0)") * F.lit(2 * _HASHES).cast("decimal(11,0)") + F.lit(_HASHES - 1).cast("decimal(11,0)")
    return kept.select(*df.columns, (F.col("__up") + F.col("__down") != alone).alias(tied))


def dedup_daily(interactions: DataFrame) -> DataFrame:
    """Last row per therapist and interaction date.

    The plans do not need it: the last row of a period is also the last of its day, so
    ``dedup_period`` gives the same with or without this step.
    """
    return keep_last(interactions, ["therapist_id", "interaction_date"])


def dedup_alltime(interactions: DataFrame) -> DataFrame:
    """Last row per therapist."""
    return keep_last(interactions, ["therapist_id"])


def dedup_period(interactions: DataFrame, period_type: str) -> DataFrame:
    """Last row per therapist and period, with ``period_start`` and the ``period`` label.

    Rows without a date belong to no period. Grouping is on the 4-byte start date; the label
    is made afterwards.
    """
    dated = interactions.filter(F.col("interaction_date").isNotNull()).withColumn(
        "period_start", period_start(F.col("interaction_date"), period_type)
    )
    return keep_last(dated, ["therapist_id", "period_start"]).withColumn(
        "period", period_label(F.col("period_start"), period_type)
    )


def distinct_organizations(df: DataFrame) -> DataFrame:
    return df.select("organization_id").distinct()
