"""DuckDB statements that state each query's result independently of the Spark plans.

They work the slow and plain way: row numbers instead of aggregated keep-last, one branch per
variant instead of a shared pass, correctly rounded printing instead of rounding arithmetic.
"""

from __future__ import annotations

PERIODS = ("weekly", "monthly", "yearly")
LEVELS = ("app", "org")
UNIT = {"weekly": "week", "monthly": "month", "yearly": "year"}

SOURCES = """
therapist AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS organization_id,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS date_joined
  FROM customer),
interaction AS (
  SELECT o_orderkey AS seq,
         CAST(o_custkey AS VARCHAR) AS therapist_id,
         CAST(o_orderdate AS DATE) AS interaction_date,
         CAST(1 AS BIGINT) AS counter,
         CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 4 END AS BIGINT) AS chat_count,
         CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS call_count,
         CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL
                   WHEN o_orderkey % 5 = 0 THEN (c_nationkey + 1) % 25
                   ELSE c_nationkey END AS BIGINT) AS organization_id,
         CAST(DATE '1994-01-01' + CAST(o_custkey % 365 AS INTEGER) AS DATE) AS organization_date_joined
  FROM orders JOIN customer ON o_custkey = c_custkey),
members AS (SELECT * FROM therapist WHERE organization_id IS NOT NULL),
valid AS (
  SELECT * FROM interaction
  WHERE organization_id IS NOT NULL AND (chat_count > 1 OR call_count >= 1)),
alltime AS (
  SELECT min(date_joined) AS period_start, max(date_joined) AS period_end, count(*) AS total_ther,
         strftime(min(date_joined), '%Y-%m-%d') || '/' || strftime(max(date_joined), '%Y-%m-%d') AS all_time_period
  FROM members),
org_size AS (SELECT organization_id, count(*) AS total_ther FROM members GROUP BY organization_id)"""

ROW = "seq, therapist_id, interaction_date, counter, chat_count, call_count, organization_id, organization_date_joined"


def _start(day: str, p: str) -> str:
    return f"CAST(date_trunc('{UNIT[p]}', {day}) AS DATE)"


def _end(start: str, p: str) -> str:
    return f"CAST({start} + INTERVAL 1 {UNIT[p]} - INTERVAL 1 DAY AS DATE)"


def _label(start: str, p: str) -> str:
    if p == "weekly":
        return f"strftime({start}, '%Y-%m-%d') || '/' || strftime({_end(start, p)}, '%Y-%m-%d')"
    return f"strftime({start}, '{'%Y-%m' if p == 'monthly' else '%Y'}')"


def _latest(p: str) -> str:
    """Last row per therapist and period."""
    return f"""
latest_{p} AS (
  SELECT *, {_label('period_start', p)} AS period
  FROM (SELECT *, {_start('interaction_date', p)} AS period_start FROM valid)
  QUALIFY row_number() OVER (PARTITION BY therapist_id, period_start ORDER BY seq DESC) = 1)"""


LATEST_ALLTIME = """
latest_alltime AS (
  SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY therapist_id ORDER BY seq DESC) = 1)"""

ACTIVE_ALLTIME = f"""{LATEST_ALLTIME},
active_app_alltime AS (
  SELECT all_time_period AS period, period_start, period_end, active_ther,
         total_ther - active_ther AS inactive_ther, total_ther
  FROM (SELECT count(*) AS active_ther FROM latest_alltime), alltime)"""


def _active(level: str, p: str) -> str:
    if p == "alltime":
        return ACTIVE_ALLTIME
    if level == "app":
        counted, org = f"SELECT period_start, count(*) AS active_ther FROM latest_{p} GROUP BY ALL", ""
        inner = f"SELECT c.*, (SELECT total_ther FROM alltime) AS total_ther FROM ({counted}) c"
    else:
        counted = f"SELECT period_start, organization_id, count(*) AS active_ther FROM latest_{p} GROUP BY ALL"
        inner = f"SELECT c.*, total_ther FROM ({counted}) c LEFT JOIN org_size USING (organization_id)"
        org = "organization_id, "
    return f"""{_latest(p)},
active_{level}_{p} AS (
  SELECT {_label('period_start', p)} AS period, period_start, {_end('period_start', p)} AS period_end, {org}
         active_ther, total_ther - active_ther AS inactive_ther, total_ther
  FROM ({inner}))"""


def _adjacent(prev: str, cur: str, p: str, strict: bool = False) -> str:
    if strict:
        return f"({cur} - {prev} = 7)" if p == "weekly" else f"(date_diff('{UNIT[p]}', {prev}, {cur}) = 1)"
    crossed = f"date_diff('month', {prev}, {cur})"
    whole = f"({crossed} - CASE WHEN {prev} + to_months(CAST({crossed} AS INTEGER)) > {cur} THEN 1 ELSE 0 END)"
    if p == "weekly":
        reached = f"CAST({prev} + to_months(CAST({whole} AS INTEGER)) AS DATE)"
        return f"(date_diff('day', {reached}, {cur}) = 7)"
    return f"({whole} % 12 = 1)" if p == "monthly" else f"({whole} // 12 = 1)"


def _before(level: str, p: str, strict: bool = False) -> str:
    by = "PARTITION BY organization_id " if level == "org" else ""
    test = _adjacent("previous_end", "period_end", p, strict)
    return f"""{_active(level, p)},
before_{level}_{p} AS (
  SELECT *, CAST(CASE WHEN {test} THEN previous_active ELSE 0 END AS BIGINT) AS active_ther_b_period,
         CAST(CASE WHEN {test} THEN previous_inactive ELSE 0 END AS BIGINT) AS inactive_ther_b_period
  FROM (SELECT *, lag(period_end) OVER w AS previous_end, lag(active_ther) OVER w AS previous_active,
               lag(inactive_ther) OVER w AS previous_inactive
        FROM active_{level}_{p}
        WINDOW w AS ({by}ORDER BY period_start, period_end)))"""


def _rounded(numerator: str) -> str:
    # printf rounds the exact binary value, half to even; + 0.0 turns -0.0 into 0.0.
    x = f"{numerator} / active_ther_b_period"
    return f"CASE WHEN active_ther_b_period = 0 THEN 0.0 ELSE CAST(printf('%.2f', CAST({x} AS DOUBLE)) AS DOUBLE) + 0.0 END"


def _rates(level: str, p: str) -> str:
    return f"""{_before(level, p)},
rates_{level}_{p} AS (
  SELECT *, CAST({_rounded('(active_ther_b_period - active_ther)')} AS DOUBLE) AS churn_rate,
         CAST({_rounded('active_ther')} AS DOUBLE) AS retention_rate
  FROM before_{level}_{p})"""


def _identity(level: str, p: str) -> str:
    org = "organization_id" if level == "org" else "CAST(NULL AS BIGINT) AS organization_id"
    return f"{org}, '{p}' AS period_type, period_start AS start_date, period_end AS end_date"


def _total_records(level: str, p: str) -> str:
    who = _identity(level, p)
    return f"""(SELECT {who}, TRUE AS is_active, active_ther AS value FROM active_{level}_{p}
 UNION ALL SELECT {who}, FALSE AS is_active, inactive_ther AS value FROM active_{level}_{p})"""


def _rate_records(level: str, p: str) -> str:
    who = _identity(level, p)
    return f"""(SELECT {who}, 'churn_rate' AS type, churn_rate AS value FROM rates_{level}_{p}
 UNION ALL SELECT {who}, 'retention_rate' AS type, retention_rate AS value FROM rates_{level}_{p})"""


RATED = [(level, p) for level in LEVELS for p in PERIODS]
TOTALLED = [("app", "alltime"), *RATED]


def _merge(ctes: list[str]) -> str:
    """Chain CTE texts, each definition once."""
    seen, kept = set(), []
    for text in ctes:
        for part in _split(text):
            name = part.strip().split(" AS ", 1)[0]
            if name not in seen:
                seen.add(name)
                kept.append(part.strip())
    return ",\n".join(kept)


def _split(text: str) -> list[str]:
    """Cut a CTE text at commas outside parentheses."""
    parts, depth, begin = [], 0, 0
    for at, char in enumerate(text):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append(text[begin:at])
            begin = at + 1
    return [*parts, text[begin:]]


def _query(select: str, *ctes: str) -> str:
    return f"WITH {_merge([SOURCES, *ctes])}\n{select}"


def _all_totals() -> tuple[str, list[str]]:
    return " UNION ALL ".join(_total_records(*v) for v in TOTALLED), [_active(*v) for v in TOTALLED]


def _all_rates() -> tuple[str, list[str]]:
    return " UNION ALL ".join(_rate_records(*v) for v in RATED), [_rates(*v) for v in RATED]


def _columns(level: str, *names: str) -> str:
    return ", ".join([*(["organization_id"] if level == "org" else []), *names])


FIGURES = ("active_ther", "inactive_ther", "total_ther")
BEFORE = ("active_ther_b_period", "inactive_ther_b_period")


def _upserted(records: str, changed: str, kind: str) -> tuple[str, str]:
    keys = ("organization_id", "period_type", "start_date", "end_date", kind)
    same = " AND ".join(f"t.{k} IS NOT DISTINCT FROM u.{k}" for k in keys)
    cols = f"organization_id, period_type, start_date, end_date, {kind}, value"
    shift = "CAST({0} + INTERVAL 120 MONTH AS DATE) AS {0}"
    later = cols.replace("start_date, end_date", f"{shift.format('start_date')}, {shift.format('end_date')}")
    return f"""
SELECT {cols} FROM ({records}) t
WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE {same})
UNION ALL SELECT {cols} FROM updates""", f"""
changed AS (SELECT {cols.replace(', value', ', value + 1 AS value')} FROM {changed}),
updates AS (SELECT {cols} FROM changed UNION ALL SELECT {later} FROM changed)"""


def _period_parts(rows: str) -> str:
    dated = " UNION ".join(
        f"SELECT '{p}-' || strftime({_start('interaction_date', p)}, '%Y-%m-%d') AS part FROM {rows} WHERE interaction_date IS NOT NULL"
        for p in PERIODS
    )
    return f"{dated} UNION SELECT 'alltime-all' AS part FROM {rows}"


#: What the last of the day-by-day runs reads: the newest rows, and some old ones that come late.
LAST_RUN = """
last_run AS (
  SELECT * FROM valid
  WHERE (seq % 10 = 0 AND interaction_date < DATE '1993-07-01') OR coalesce(interaction_date >= DATE '1998-07-01', true)),
earlier_runs AS (SELECT * FROM valid ANTI JOIN last_run USING (seq))"""


def statements() -> dict[str, str]:
    sql = {
        "scan_therapist": _query("SELECT id, organization_id, date_joined FROM therapist"),
        "scan_interaction": _query(f"SELECT {ROW} FROM interaction"),
        "clean_therapists": _query("SELECT id, organization_id, date_joined FROM members"),
        "clean_interactions": _query(f"SELECT {ROW} FROM valid"),
        "alltime_period": _query("SELECT period_start, period_end, total_ther, all_time_period FROM alltime"),
        "total_all": _query("SELECT all_time_period AS period, total_ther AS total FROM alltime"),
        "total_per_org": _query(
            "SELECT all_time_period AS period, organization_id, org_size.total_ther AS total FROM org_size, alltime"
        ),
        "therapist_input": _query("SELECT all_time_period, organization_id, id FROM members, alltime"),
        "interaction_org_totals": _query(
            "SELECT seq, therapist_id, organization_id, total_ther AS total_thers_in_org "
            "FROM valid LEFT JOIN org_size USING (organization_id)"
        ),
        "period_labels": _query(
            "SELECT seq, interaction_date, "
            + ", ".join(f"{_label(_start('interaction_date', p), p)} AS {p}" for p in PERIODS)
            + " FROM interaction"
        ),
        "dedup_daily": _query(
            f"SELECT {ROW} FROM valid "
            "QUALIFY row_number() OVER (PARTITION BY therapist_id, interaction_date ORDER BY seq DESC) = 1"
        ),
        "dedup_alltime": _query(
            f"SELECT {ROW}, all_time_period, total_ther AS all_time_thers FROM latest_alltime, alltime", LATEST_ALLTIME
        ),
        "distinct_orgs": _query("SELECT DISTINCT organization_id FROM valid"),
        "active_alltime": _query(f"SELECT period, {', '.join(FIGURES)} FROM active_app_alltime", ACTIVE_ALLTIME),
        "activity_summary": _query(
            " UNION ALL ".join(
                f"SELECT '{level}' AS level, '{p}' AS period_type, "
                + ("organization_id" if level == "org" else "CAST(NULL AS BIGINT) AS organization_id")
                + f", period_start, period_end, {', '.join(FIGURES)} FROM active_{level}_{p}"
                for level, p in TOTALLED
            ),
            *(_active(*v) for v in TOTALLED),
        ),
        "chart_year_range": _query(
            " UNION ALL ".join(
                f"SELECT '{p}' AS period_type, CAST(year(min(period_start)) AS INTEGER) AS min_year, "
                f"CAST(year(max(period_end)) + 1 AS INTEGER) AS max_year FROM active_app_{p}"
                for p in PERIODS
            ),
            *(_active("app", p) for p in PERIODS),
        ),
    }
    sql["chart_rates_year_range"] = sql["chart_year_range"]
    totals, total_ctes = _all_totals()
    rates, rate_ctes = _all_rates()
    sql["serving_totals"] = _query(totals, *total_ctes)
    sql["serving_rates"] = _query(rates, *rate_ctes)
    select, ctes = _upserted(totals, _total_records("app", "yearly"), "is_active")
    sql["upsert_totals"] = _query(select, *total_ctes, ctes)
    select, ctes = _upserted(rates, _rate_records("app", "yearly"), "type")
    sql["upsert_rates"] = _query(select, *rate_ctes, ctes)

    sql["last_day_ties"] = _query(
        "SELECT organization_id, CAST(interaction_date - DATE '1970-01-01' AS BIGINT) AS day, count(DISTINCT seq) > 1 AS tied "
        "FROM (SELECT *, max(interaction_date) OVER (PARTITION BY organization_id) AS last FROM valid) "
        "WHERE interaction_date = last GROUP BY organization_id, interaction_date"
    )
    quarter = "interaction_date BETWEEN DATE '1997-04-01' AND DATE '1997-06-30'"
    sql["quarter_summary"] = sql["activity_summary"].replace("SELECT * FROM interaction\n  WHERE", f"SELECT * FROM interaction\n  WHERE {quarter} AND")
    sql["upsert_parts_totals"], sql["upsert_parts_rates"] = sql["upsert_totals"], sql["upsert_rates"]
    sql["daily_summary"], sql["daily_rates"] = sql["activity_summary"], sql["serving_rates"]
    sql["daily_touched"] = _query(_period_parts("last_run"), LAST_RUN)
    sql["daily_kept"] = _query(f"({_period_parts('earlier_runs')}) EXCEPT ({_period_parts('last_run')})", LAST_RUN)

    sql["interaction_input_app_alltime"] = _query(
        "SELECT all_time_period, total_ther AS all_time_thers, therapist_id FROM latest_alltime, alltime", LATEST_ALLTIME
    )
    for level, p in TOTALLED:
        sent = "*" if level == "org" else "* EXCLUDE (organization_id)"
        sql[f"serve_totals_{level}_{p}"] = _query(f"SELECT {sent} FROM {_total_records(level, p)}", _active(level, p))
    for level, p in RATED:
        figures, before = _columns(level, *FIGURES), ", ".join(BEFORE)
        bounds = "period_start, period_end"
        sql[f"active_{level}_{p}"] = _query(f"SELECT period, {figures} FROM active_{level}_{p}", _active(level, p))
        sql[f"sorted_active_{level}_{p}"] = _query(
            f"SELECT {bounds}, {figures} FROM active_{level}_{p} ORDER BY {bounds}", _active(level, p)
        )
        for name, strict in (("before_period", False), ("before_period_strict", True)):
            sql[f"{name}_{level}_{p}"] = _query(
                f"SELECT {bounds}, {figures}, {before} FROM before_{level}_{p}", _before(level, p, strict)
            )
        sql[f"rates_{level}_{p}"] = _query(
            f"SELECT {bounds}, {_columns(level, 'churn_rate', 'retention_rate')} FROM rates_{level}_{p}",
            _rates(level, p),
        )
        sent = "*" if level == "org" else "* EXCLUDE (organization_id)"
        sql[f"serve_rates_{level}_{p}"] = _query(f"SELECT {sent} FROM {_rate_records(level, p)}", _rates(level, p))
    for p in PERIODS:
        sql[f"interaction_input_app_{p}"] = _query(
            f"SELECT period, total_ther AS all_time_thers, therapist_id "
            f"FROM latest_{p}, (SELECT total_ther FROM alltime)",
            _latest(p),
        )
        sql[f"interaction_input_org_{p}"] = _query(
            f"SELECT period, organization_id, total_ther AS total_thers_in_org, therapist_id "
            f"FROM latest_{p} LEFT JOIN org_size USING (organization_id)",
            _latest(p),
        )
        start = _start("interaction_date", p)
        sql[f"period_bounds_{p}"] = _query(
            f"SELECT DISTINCT {start} AS period_start, {_end(start, p)} AS period_end, "
            f"{_label(start, p)} AS label FROM interaction"
        )
        sql[f"period_gap_{p}"] = _query(
            f"SELECT DISTINCT previous_end, period_end, {_adjacent('previous_end', 'period_end', p)} AS adjacent, "
            f"{_adjacent('previous_end', 'period_end', p, True)} AS adjacent_strict FROM ("
            f"SELECT period_end, lag(period_end) OVER (PARTITION BY therapist_id ORDER BY period_end) AS previous_end "
            f"FROM (SELECT DISTINCT therapist_id, {_end(start, p)} AS period_end FROM interaction)) "
            "WHERE previous_end IS NOT NULL"
        )
        sql[f"dedup_period_{p}"] = _query(f"SELECT {ROW}, period FROM latest_{p}", _latest(p))
        for name, records, kind, first, ctes in (
            ("totals", _total_records("org", p), "is_active", "is_active DESC", _active("org", p)),
            ("rates", _rate_records("org", p), "type", "type", _rates("org", p)),
        ):
            record = (
                f"{{'period_type': period_type, 'start_date': start_date, 'end_date': end_date, "
                f"'{kind}': {kind}, 'value': value}}"
            )
            sql[f"grouped_{name}_org_{p}"] = _query(
                f"SELECT organization_id, CAST(to_json(list({record} ORDER BY start_date, {first})) AS VARCHAR) "
                f"AS records FROM {records} GROUP BY organization_id",
                ctes,
            )
        for name, records, kind, ctes in (
            ("totals", _total_records("app", p), "CASE WHEN is_active THEN 'active' ELSE 'inactive' END", _active("app", p)),
            ("rates", _rate_records("app", p), "type", _rates("app", p)),
        ):
            if p == "yearly":
                year, inside = "", "TRUE"
            else:
                year, inside = "CAST(year(start_date) AS INTEGER) AS chart_year, ", "year(start_date) = year(end_date)"
            sql[f"chart_{name}_{p}"] = _query(
                f"SELECT {year}{_label('start_date', p)} AS period, {kind} AS type, "
                f"avg(value) AS value FROM {records} WHERE {inside} GROUP BY ALL",
                ctes,
            )
    return sql
