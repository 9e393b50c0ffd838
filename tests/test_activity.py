from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pandas as pd
import pytest
from dateutil.relativedelta import relativedelta

import frames
from frames import day
from membertide.operators.activity import active_therapists, activity_summary, last_organization, with_org_totals
from membertide.operators.totals import alltime_period, count_totals, total_all, total_per_org
from membertide.plans import kpis
from membertide.schemas import APP, ORG, RATE_VARIANTS, TOTAL_VARIANTS

MEMBERS = [("a", 1, "2020-03-01"), ("b", 1, "2019-05-05"), ("c", 2, "2021-07-09"), ("d", None, "2000-01-01"), ("c", 2, None)]
ROWS = [
    (1, "a", "2020-12-28", 1), (2, "a", "2021-01-02", 2), (3, "b", "2021-01-03", 1), (4, "a", "2021-01-31", 1),
    (5, "c", "2021-02-01", 3), (6, "c", "2021-02-02", 2, 0, 0), (7, "e", "2021-02-28", 9), (8, "e", None, 1),
    (9, "a", "2021-02-07", None), (10, "b", "2021-01-03", 2),
]


@pytest.fixture(scope="module")
def sources(spark):
    return frames.interactions(spark, ROWS), frames.therapists(spark, MEMBERS)


def test_totals(sources):
    _, therapists = sources
    members = therapists.filter("organization_id IS NOT NULL")
    label = "2019-05-05/2021-07-09"
    assert frames.rows(alltime_period(members)) == [(day("2019-05-05"), day("2021-07-09"), 4, label)]
    assert frames.rows(total_all(count_totals(members))) == [(label, 4)]
    assert frames.rows(total_per_org(count_totals(members))) == [(label, 1, 2), (label, 2, 2)]


def _brute(level, period_type, rows=ROWS, members=MEMBERS):
    valid = [r for r in rows if r[3] is not None and (len(r) < 5 or r[4] > 1 or r[5] >= 1)]
    last = {}
    for seq, who, when, org, *_ in sorted(valid):
        if period_type == "alltime":
            period = "2019-05-05/2021-07-09"
        elif when is None:
            continue
        else:
            period = str(pd.Timestamp(when).to_period(period_type[0].upper()))
        last[who, period] = org
    counts = Counter((period, *([org] if level == ORG else [])) for (_, period), org in last.items())
    sizes = Counter(org for _, org, _ in members if org is not None)
    found = []
    for key, n in counts.items():
        total = sum(sizes.values()) if level == APP else sizes.get(key[1])
        found.append((*key, n, None if total is None else total - n, total))
    return sorted(found, key=repr)


@pytest.mark.parametrize("level, period_type", TOTAL_VARIANTS)
def test_variant_against_brute_force(sources, level, period_type):
    assert frames.rows(kpis.active(*sources, level, period_type)) == _brute(level, period_type)


def test_unknown_organization_has_null_total_and_inactive(sources):
    found = [r for r in frames.rows(kpis.active(*sources, ORG, "yearly")) if r[1] == 9]
    assert found == [("2021", 9, 1, None, None)]


def test_all_time_inactive_may_be_negative(spark, sources):
    few = frames.therapists(spark, MEMBERS[:1])
    assert kpis.active(sources[0], few, APP, "alltime").first().inactive_ther == 1 - 4


def test_summary_holds_every_variant(sources):
    summary = kpis.summary(*sources)
    for level, period_type in TOTAL_VARIANTS:
        part = summary.filter(f"level = '{level}' AND period_type = '{period_type}'")
        columns = ["period_start", "period_end", *(["organization_id"] if level == ORG else []),
                   "active_ther", "inactive_ther", "total_ther"]
        interactions, therapists = sources
        alone = active_therapists(
            interactions.filter("organization_id IS NOT NULL AND (chat_count > 1 OR call_count >= 1)"),
            count_totals(therapists.filter("organization_id IS NOT NULL")), level, period_type,
        )
        assert frames.rows(part, *columns) == frames.rows(alone, *columns)
    assert summary.filter("level = 'org' AND period_type = 'alltime'").count() == 0


def test_no_input_no_rows(spark):
    nothing = frames.interactions(spark, [])
    nobody = frames.therapists(spark, [])
    for level, period_type in TOTAL_VARIANTS:
        assert kpis.active(nothing, nobody, level, period_type).count() == 0
    assert activity_summary(last_organization(nothing), count_totals(nobody)).count() == 0
    assert total_all(count_totals(nobody)).count() == 0


def test_org_totals_without_broadcast_and_with_a_dominant_organization(spark):
    rows = [(n, f"t{n}", "2021-01-01", 1 if n % 3 == 0 else n % 50) for n in range(3000)]
    df = frames.interactions(spark, rows)
    therapists = frames.therapists(spark, [(str(n), n % 40, "2020-01-01") for n in range(400)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = with_org_totals(df, count_totals(therapists))
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().toString()
        found = {r.seq: r.total_thers_in_org for r in joined.select("seq", "total_thers_in_org").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {n: (10 if org < 40 else None) for n, _, _, org in rows}


def test_org_totals_build_one_row_per_organization(spark):
    many = spark.range(200_000).selectExpr("CAST(id AS STRING) AS id", "id AS organization_id", "DATE '2020-01-01' AS date_joined")
    df = frames.interactions(spark, [(n, f"t{n}", "2021-01-01", n) for n in range(50)])
    joined = with_org_totals(df, count_totals(many))
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text and "explode" not in text
    assert {r.total_thers_in_org for r in joined.collect()} == {1}


def test_a_dominant_organization_is_split(spark):
    rows = spark.range(400_000).selectExpr(
        "id AS seq", "CAST(id AS STRING) AS therapist_id", "DATE '2021-01-01' AS interaction_date", "1L AS counter",
        "2L AS chat_count", "0L AS call_count", "IF(id % 2 = 0, 7L, id % 5000) AS organization_id",
        "DATE '2020-01-01' AS organization_date_joined",
    )
    members = spark.range(5000).selectExpr("CAST(id AS STRING) AS id", "id AS organization_id", "DATE '2020-01-01' AS date_joined")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = with_org_totals(rows, count_totals(members)).select("seq", "therapist_id", "total_thers_in_org")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_levels_and_periods_are_checked(sources):
    with pytest.raises(ValueError):
        kpis.active(*sources, ORG, "alltime")
    with pytest.raises(ValueError):
        kpis.rates(*sources, APP, "alltime")


@pytest.fixture(scope="module")
def many():
    """Sparse activity over six years, so that every kind of gap occurs."""
    rnd = random.Random(11)
    rows = []
    for seq in rnd.sample(range(100_000), 1500):
        org = rnd.choice([0, 0, 0, 1, 2, 3, 4, None])
        days = rnd.randrange(2200) if org in (0, None) else rnd.choice([30, 400, 441, 800, 1500]) + rnd.randrange(40)
        rows.append((seq, f"t{rnd.randrange(60)}", str(date(2016, 1, 1) + timedelta(days=days)), org,
                     rnd.choice([0, 1, 2, 5]), rnd.choice([0, 0, 1])))
    members = [(f"t{n}", rnd.choice([0, 1, 2, None]), "2016-01-01") for n in range(60)]
    return rows, members


def _row_by_row(level, period_type, rows, members):
    """Before-period figures and rates by walking the sorted periods one by one."""
    series = {}
    for label, *rest in _brute(level, period_type, rows, members):
        org, figures = (rest[0], rest[1:]) if level == ORG else (None, rest)
        span = pd.Period(label.split("/")[0], period_type[0].upper())
        series.setdefault(org, []).append((span.start_time.date(), span.end_time.date(), *figures))
    inputs, rated = [], []
    unit = {"weekly": ("days", 7), "monthly": ("months", 1), "yearly": ("years", 1)}[period_type]
    for org, found in series.items():
        previous = None
        for row in sorted(found):
            before = (0, 0)
            if previous and getattr(relativedelta(row[1], previous[1]), unit[0]) == unit[1]:
                before = previous[2:4]
            who = (org,) if level == ORG else ()
            inputs.append((*row[:2], *who, *row[2:], *before))
            b, w = before[0], row[2]
            rated.append((*row[:2], *who, *((round((b - w) / b, 2), round(w / b, 2)) if b else (0.0, 0.0))))
            previous = row
    return sorted(inputs, key=repr), sorted(rated, key=repr)


@pytest.mark.parametrize("level, period_type", RATE_VARIANTS)
def test_rates_against_a_row_by_row_walk(spark, many, level, period_type):
    rows, members = many
    sources = frames.interactions(spark, rows), frames.therapists(spark, members)
    inputs, rated = _row_by_row(level, period_type, rows, members)
    assert frames.rows(kpis.rate_input(*sources, level, period_type)) == inputs
    assert [tuple(x + 0.0 if isinstance(x, float) else x for x in row) for row in rated] == frames.rows(
        kpis.rates(*sources, level, period_type))
    assert len({row[-2] for row in inputs}) > 1
