"""Row filters applied to the two source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_CHATS_EXCLUSIVE = 1
MIN_CALLS = 1


def clean_therapists(therapists: DataFrame) -> DataFrame:
    """Keep therapists that belong to an organization."""
    return therapists.filter(F.col("organization_id").isNotNull())


def clean_interactions(interactions: DataFrame) -> DataFrame:
    """Keep interactions of an organization with a reply (two chats) or a call.

    An unknown count satisfies nothing: a row passes only if one of the two tests is true.
    """
    replied = F.col("chat_count") > MIN_CHATS_EXCLUSIVE
    called = F.col("call_count") >= MIN_CALLS
    return interactions.filter(F.col("organization_id").isNotNull() & (replied | called))
