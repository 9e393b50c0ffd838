from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import frames
from membertide.operators.cleaning import clean_interactions, clean_therapists
from membertide.operators.dedup import dedup_alltime, dedup_daily, dedup_period, distinct_organizations, keep_last
from membertide.schemas import CALENDAR_PERIODS


@pytest.mark.parametrize(
    "chats, calls, kept",
    [(2, 0, True), (1, 0, False), (1, 1, True), (None, 1, True), (2, None, True), (None, 0, False), (None, None, False), (1, None, False)],
)
def test_valid_interactions(spark, chats, calls, kept):
    df = frames.interactions(spark, [(1, "a", "2021-01-01", 7, chats, calls)])
    assert clean_interactions(df).count() == int(kept)


def test_rows_without_organization_go(spark):
    assert clean_interactions(frames.interactions(spark, [(1, "a", "2021-01-01", None)])).count() == 0
    df = frames.therapists(spark, [("a", None, "2021-01-01"), ("b", 1, None)])
    assert frames.rows(clean_therapists(df), "id") == [("b",)]


@pytest.fixture(scope="module")
def random_rows():
    rnd = random.Random(5)
    seqs = rnd.sample(range(10_000), 900)
    # One therapist holds a third of all rows.
    return [
        (s, "hot" if i % 3 == 0 else f"t{rnd.randrange(20)}",
         None if rnd.random() < 0.03 else f"20{rnd.randrange(19, 22)}-{rnd.randrange(1, 13):02}-{rnd.randrange(1, 29):02}",
         rnd.randrange(4), rnd.choice([None, 2, 3]), rnd.choice([0, 1, None]))
        for i, s in enumerate(seqs)
    ]


def _last(rows, key):
    found = {}
    for row in sorted(rows):
        found[key(row)] = row
    return sorted(found.values())


def _plain(df):
    return sorted(
        (r.seq, r.therapist_id, None if r.interaction_date is None else str(r.interaction_date), r.organization_id,
         r.chat_count, r.call_count)
        for r in df.collect()
    )


def test_daily_keeps_the_whole_last_row(spark, random_rows):
    df = frames.interactions(spark, random_rows)
    assert _plain(dedup_daily(df)) == _last(random_rows, lambda r: (r[1], r[2]))


def test_alltime(spark, random_rows):
    df = frames.interactions(spark, random_rows)
    assert _plain(dedup_alltime(df)) == _last(random_rows, lambda r: r[1])


@pytest.mark.parametrize("period_type", CALENDAR_PERIODS)
def test_period_same_with_or_without_daily_and_idempotent(spark, random_rows, period_type):
    df = frames.interactions(spark, random_rows)
    once = dedup_period(df, period_type)
    assert _plain(once) == _plain(dedup_period(dedup_daily(df), period_type))
    assert _plain(once) == _plain(dedup_period(once.select(*df.columns), period_type))
    assert once.filter("interaction_date IS NULL").count() == 0


def test_order_may_be_a_struct(spark, random_rows):
    df = frames.interactions(spark, random_rows)
    by_struct = df.withColumn("seq", F.struct(F.lit("file"), F.lit(0).alias("block"), F.col("seq").alias("row")))
    kept = keep_last(by_struct, ["therapist_id"]).withColumn("seq", F.col("seq.row"))
    assert _plain(kept) == _plain(keep_last(df, ["therapist_id"]))


def test_distinct_organizations(spark):
    df = frames.interactions(spark, [(1, "a", "2021-01-01", 1), (2, "b", "2021-01-01", 1), (3, "b", "2021-01-01", 2)])
    assert frames.rows(distinct_organizations(df)) == [(1,), (2,)]
