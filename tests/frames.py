"""Hand-made source rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

INTERACTION = (
    "seq BIGINT, therapist_id STRING, interaction_date DATE, counter BIGINT, chat_count BIGINT, "
    "call_count BIGINT, organization_id BIGINT, organization_date_joined DATE"
)
THERAPIST = "id STRING, organization_id BIGINT, date_joined DATE"


def day(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def interactions(spark: SparkSession, rows) -> DataFrame:
    """Rows are ``seq, therapist, date, organization[, chats, calls]``."""
    full = [
        (seq, who, day(when), 1, rest[0] if rest else 2, rest[1] if len(rest) > 1 else 0, org, None)
        for seq, who, when, org, *rest in rows
    ]
    return spark.createDataFrame(full, INTERACTION)


def therapists(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame([(i, org, day(joined)) for i, org, joined in rows], THERAPIST)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
