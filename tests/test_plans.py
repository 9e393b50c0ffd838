"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from compare import plan
from membertide.operators.cleaning import clean_interactions
from membertide.operators.dedup import dedup_daily, dedup_period
from membertide.plans import kpis
from membertide.schemas import ORG
from membertide.sources import star_tables


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The interactions as a table of their own."""
    path = str(tmp_path_factory.mktemp("stored") / "interactions")
    star_tables.interactions(spark, sf_dir).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield spark.read.parquet(path), star_tables.therapists(spark, sf_dir)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _reads(text: str, column: str) -> list[str]:
    return [line for line in re.findall(r"ReadSchema: struct<[^>]*>", text) if column in line]


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(kpis.active(*stored, ORG, "weekly"))
    assert "Or(GreaterThan(chat_count,1),GreaterThanOrEqual(call_count,1))" in text
    assert "IsNotNull(organization_id)" in text
    (read,) = _reads(text, "therapist_id")
    assert "counter" not in read and "organization_date_joined" not in read


def test_one_heavy_shuffle_per_variant(stored):
    """One exchange by therapist, then only those of counted rows."""
    text = plan(kpis.active(*stored, ORG, "weekly"))
    assert len(re.findall(r"Exchange hashpartitioning\(therapist_id", text)) == 1
    assert "partial_max_by" in text


def test_all_variants_from_one_scan(stored):
    for build in (kpis.serving_totals, kpis.serving_rates):
        text = plan(build(*stored))
        assert len(_reads(text, "therapist_id")) == 1
        assert len(re.findall(r"Exchange hashpartitioning\(therapist_id", text)) == 2


def test_deduplication_is_hash_aggregation(stored):
    interactions = clean_interactions(stored[0])
    for df in (dedup_daily(interactions), dedup_period(interactions, "monthly")):
        text = plan(df)
        assert "HashAggregate" in text and "Sort" not in text and "Window" not in text


def test_results_do_not_depend_on_the_time_zone(spark, stored):
    def results():
        return [
            sorted(map(tuple, df.collect()), key=repr)
            for df in (kpis.rates(*stored, ORG, "monthly"), kpis.serving_totals(*stored))
        ]

    before, here = spark.conf.get("spark.sql.session.timeZone"), results()
    try:
        for zone in ("America/Sao_Paulo", "Pacific/Apia"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert results() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lag_is_computed_once(stored):
    text = plan(kpis.rates(*stored, ORG, "monthly"))
    (window,) = re.findall(r"\+- Window \[.*", text)
    assert window.count("lag(") == 2  # the previous end and the previous active; inactive is pruned
