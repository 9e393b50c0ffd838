from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import frames
from compare import plan
from frames import day
from membertide.operators import charts, serving
from membertide.operators.history import sort_by_period, with_bounds, with_previous
from membertide.plans import kpis
from membertide.schemas import (
    APP, COMPAT, ORG, RATE_KEYS, RATE_RECORD, RATE_VARIANTS, STRICT, TOTAL_KEYS, TOTAL_RECORD, TOTAL_VARIANTS,
)
from membertide.sources import star_tables

FIGURES = "period_start DATE, period_end DATE, organization_id BIGINT, active_ther BIGINT, inactive_ther BIGINT"


def _series(spark, period_type, ends, org=1):
    days = {"weekly": 6, "monthly": 27, "yearly": 364}[period_type]
    text = ", ".join(f"(DATE'{end}', {active})" for end, active in ends)
    return spark.sql(
        f"SELECT date_sub(e, {days}) AS period_start, e AS period_end, {org}L AS organization_id, "
        f"CAST(a AS BIGINT) AS active_ther, CAST(100 - a AS BIGINT) AS inactive_ther FROM VALUES {text} AS t(e, a)"
    )


@pytest.mark.parametrize(
    "period_type, ends, compat, strict",
    [
        ("weekly", [("2021-01-10", 5)], [0], [0]),
        ("weekly", [("2021-01-10", 5), ("2021-01-17", 3)], [0, 5], [0, 5]),
        ("weekly", [("2021-01-10", 5), ("2021-01-24", 3)], [0, 0], [0, 0]),
        ("weekly", [("2021-02-07", 5), ("2021-03-14", 3)], [0, 5], [0, 0]),
        ("monthly", [("2021-01-31", 4), ("2021-02-28", 2), ("2021-03-31", 6)], [0, 4, 2], [0, 4, 2]),
        ("monthly", [("2021-01-31", 4), ("2021-03-31", 6)], [0, 0], [0, 0]),
        ("monthly", [("2020-01-31", 4), ("2021-02-28", 6)], [0, 4], [0, 0]),
        ("yearly", [("2019-12-31", 7), ("2020-12-31", 8), ("2022-12-31", 1)], [0, 7, 0], [0, 7, 0]),
    ],
)
def test_before_period(spark, period_type, ends, compat, strict):
    other = _series(spark, period_type, [("2021-01-03", 50)], org=2)
    df = _series(spark, period_type, ends).unionByName(other)
    for adjacency, expected in ((COMPAT, compat), (STRICT, strict)):
        found = with_previous(df, period_type, adjacency)
        ours = sorted((r.period_end, r.active_ther_b_period, r.inactive_ther_b_period)
                      for r in found.collect() if r.organization_id == 1)
        assert [r[1] for r in ours] == expected
        assert [r[2] for r in ours] == [100 - b if b else 0 for b in expected]
        # The type may also be a column of the frame.
        typed = with_previous(df.withColumn("period_type", F.lit(period_type)), adjacency=adjacency)
        assert frames.rows(typed, *found.columns) == frames.rows(found)


def test_unknown_inactive_is_carried_as_unknown(spark):
    df = _series(spark, "weekly", [("2021-01-10", 5), ("2021-01-17", 3)]).withColumn(
        "inactive_ther", F.lit(None).cast("bigint"))
    found = with_previous(df, "weekly").orderBy("period_end").collect()
    assert [(r.active_ther_b_period, r.inactive_ther_b_period) for r in found] == [(0, 0), (5, None)]


def test_sort_puts_unknown_dates_last(spark):
    df = spark.createDataFrame([("2021-02", 1), ("bad", 2), ("2020-12", 3)], "period STRING, active_ther BIGINT")
    found = sort_by_period(with_bounds(df, "monthly")).collect()
    assert [r.active_ther for r in found] == [3, 1, 2]
    assert (found[0].period_start, found[0].period_end) == (day("2020-12-01"), day("2020-12-31"))


def test_records(spark):
    df = _series(spark, "weekly", [("2021-01-10", 5)])
    assert frames.rows(serving.total_records(df.drop("organization_id"), "weekly")) == [
        (None, "weekly", day("2021-01-04"), day("2021-01-10"), False, 95),
        (None, "weekly", day("2021-01-04"), day("2021-01-10"), True, 5),
    ]
    rated = df.withColumns({"churn_rate": F.lit(0.25), "retention_rate": F.lit(0.75)})
    assert frames.rows(serving.rate_records(rated, "weekly")) == [
        (1, "weekly", day("2021-01-04"), day("2021-01-10"), "churn_rate", 0.25),
        (1, "weekly", day("2021-01-04"), day("2021-01-10"), "retention_rate", 0.75),
    ]


def test_records_per_organization_are_in_order(spark):
    df = _series(spark, "weekly", [("2021-01-17", 3), ("2021-01-10", 5)]).unionByName(
        _series(spark, "weekly", [("2021-01-10", 9)], org=2))
    app = serving.total_records(df.drop("organization_id"), "weekly")
    grouped = serving.records_by_org(serving.total_records(df, "weekly").unionByName(app))
    found = {r.organization_id: [(str(x.end_date), x.is_active, x.value) for x in r.records] for r in grouped.collect()}
    assert found == {
        1: [("2021-01-10", True, 5), ("2021-01-10", False, 95), ("2021-01-17", True, 3), ("2021-01-17", False, 97)],
        2: [("2021-01-10", True, 9), ("2021-01-10", False, 91)],
    }


@pytest.fixture(scope="module")
def sources(spark, sf_dir):
    return star_tables.both(spark, sf_dir)


def test_one_pass_equals_union_of_feeds(sources):
    feeds = serving.union_feeds(kpis.total_feed(*sources, *v) for v in TOTAL_VARIANTS)
    assert frames.rows(kpis.serving_totals(*sources)) == frames.rows(feeds)
    feeds = serving.union_feeds(kpis.rate_feed(*sources, *v) for v in RATE_VARIANTS)
    assert frames.rows(kpis.serving_rates(*sources)) == frames.rows(feeds)


def test_active_and_inactive_make_up_the_total(sources):
    for level in (APP, ORG):
        df = kpis.active(*sources, level, "monthly")
        assert df.filter("active_ther + inactive_ther <> total_ther").count() == 0


def test_churn_and_retention_make_up_one(sources):
    df = kpis.rates(*sources, ORG, "monthly").filter("churn_rate <> 0 OR retention_rate <> 0")
    assert df.filter("abs(churn_rate + retention_rate - 1) > 0.0100001").count() == 0


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("schema, keys, kinds", [(TOTAL_RECORD, TOTAL_KEYS, (True, False)), (RATE_RECORD, RATE_KEYS, ("churn_rate", "x"))])
def test_upsert(spark, threshold, schema, keys, kinds):
    d1, d2 = day("2021-01-01"), day("2021-12-31")
    number = float if schema is RATE_RECORD else int

    def table(rows):
        return spark.createDataFrame([(o, "yearly", d1, d2, k, number(v)) for o, k, v in rows], schema)

    target = table([(None, kinds[0], 1), (None, kinds[1], 2), (5, kinds[0], 3)])
    updates = table([(None, kinds[0], 10), (6, kinds[1], 11)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        once = serving.upsert(target, updates, keys)
        assert "NestedLoop" not in plan(once)  # an equi-join in spite of the NULL keys
        expected = table([(None, kinds[0], 10), (None, kinds[1], 2), (5, kinds[0], 3), (6, kinds[1], 11)])
        assert frames.rows(once) == frames.rows(expected)
        assert frames.rows(serving.upsert(once, updates, keys)) == frames.rows(once)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _export(spark, rows):
    return spark.createDataFrame(
        [(o, t, p, day(s), day(e), v) for o, t, p, s, e, v in rows],
        "organization_id BIGINT, type STRING, period_type STRING, start_date DATE, end_date DATE, value BIGINT",
    )


def test_chart_bars(spark):
    export = _export(spark, [
        (None, "active", "weekly", "2020-12-28", "2021-01-03", 9),
        (None, "active", "weekly", "2021-01-04", "2021-01-10", 4),
        (None, "active", "weekly", "2021-01-04", "2021-01-10", 5),
        (None, "inactive", "weekly", "2021-01-04", "2021-01-10", 1),
        (3, "active", "weekly", "2021-01-04", "2021-01-10", 100),
        (None, "active", "monthly", "2020-12-01", "2020-12-31", 7),
        (None, "active", "yearly", "2020-01-01", "2020-12-31", 8),
    ])
    assert frames.rows(charts.bars(export, "weekly")) == [
        (2021, "2021-01-04/2021-01-10", "active", 4.5), (2021, "2021-01-04/2021-01-10", "inactive", 1.0)]
    assert frames.rows(charts.bars(export, "monthly")) == [(2020, "2020-12", "active", 7.0)]
    assert frames.rows(charts.bars(export, "yearly")) == [("2020", "active", 8.0)]
    assert frames.rows(charts.year_range(export, "weekly")) == [(2020, 2022)]


def test_export_names_the_kind(spark):
    records = serving.total_records(_series(spark, "weekly", [("2021-01-10", 5)]), "weekly")
    assert frames.rows(charts.totals_export(records), "type", "value") == [("active", 5), ("inactive", 95)]
