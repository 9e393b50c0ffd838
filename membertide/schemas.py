"""Table schemas, period types and levels shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

ALLTIME = "alltime"
WEEKLY = "weekly"
MONTHLY = "monthly"
YEARLY = "yearly"
CALENDAR_PERIODS = (WEEKLY, MONTHLY, YEARLY)

APP = "app"
ORG = "org"
LEVELS = (APP, ORG)

COMPAT = "compat"
STRICT = "strict"
ADJACENCIES = (COMPAT, STRICT)

# All-time exists for the whole application only; it has totals but no rates.
TOTAL_VARIANTS = ((APP, ALLTIME),) + tuple((lv, p) for lv in LEVELS for p in CALENDAR_PERIODS)
RATE_VARIANTS = tuple((lv, p) for lv in LEVELS for p in CALENDAR_PERIODS)


def check_variant(level: str, period_type: str, variants=TOTAL_VARIANTS) -> None:
    if (level, period_type) not in variants:
        raise ValueError(f"no {period_type!r} figures at level {level!r}")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_S, _L, _D, _DT, _TS, _B = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampNTZType(),
    T.BooleanType(),
)

# Timestamps carry no zone, so truncating them to a date never depends on the session.
THERAPIST = _struct(("id", _S), ("organization_id", _L), ("date_joined", _TS))

INTERACTION = _struct(
    ("therapist_id", _S),
    ("interaction_date", _TS),
    ("counter", _L),
    ("chat_count", _L),
    ("call_count", _L),
    ("organization_id", _L),
    ("organization_date_joined", _TS),
)

THERAPIST_INPUT = _struct(("all_time_period", _S), ("organization_id", _L), ("id", _S))
TOTAL_ALL = _struct(("all_time_period", _S), ("all_time_thers", _L))
TOTAL_PER_ORG = _struct(("period", _S), ("organization_id", _L), ("total_thers_in_org", _L))

INTERACTION_INPUT = {
    (APP, ALLTIME): _struct(("all_time_period", _S), ("all_time_thers", _L), ("therapist_id", _S)),
    **{
        (APP, p): _struct(("period", _S), ("all_time_thers", _L), ("therapist_id", _S))
        for p in CALENDAR_PERIODS
    },
    **{
        (ORG, p): _struct(
            ("period", _S), ("organization_id", _L), ("total_thers_in_org", _L), ("therapist_id", _S)
        )
        for p in CALENDAR_PERIODS
    },
}


def _org(level: str) -> tuple:
    return (("organization_id", _L),) if level == ORG else ()


def active(level: str) -> T.StructType:
    """Active / inactive / total per period label."""
    return _struct(
        ("period", _S), *_org(level), ("active_ther", _L), ("inactive_ther", _L), ("total_ther", _L)
    )


def rate_input(level: str) -> T.StructType:
    """Active figures with those of the period before."""
    return _struct(
        ("period_start", _DT),
        ("period_end", _DT),
        *_org(level),
        ("active_ther", _L),
        ("inactive_ther", _L),
        ("total_ther", _L),
        ("active_ther_b_period", _L),
        ("inactive_ther_b_period", _L),
    )


def rate_output(level: str) -> T.StructType:
    return _struct(
        ("period_start", _DT),
        ("period_end", _DT),
        *_org(level),
        ("churn_rate", _D),
        ("retention_rate", _D),
    )


#: What a day-by-day run keeps: the last row per therapist and period, and counts of them.
STATE = _struct(
    ("therapist_id", _S), ("period_type", _S), ("period_start", _DT), ("organization_id", _L), ("seq", _L)
)
COUNTS = _struct(("period_type", _S), ("period_start", _DT), ("organization_id", _L), ("n", _L))

TOTAL_RECORD = _struct(
    ("organization_id", _L),
    ("period_type", _S),
    ("start_date", _DT),
    ("end_date", _DT),
    ("is_active", _B),
    ("value", _L),
)
RATE_RECORD = _struct(
    ("organization_id", _L),
    ("period_type", _S),
    ("start_date", _DT),
    ("end_date", _DT),
    ("type", _S),
    ("value", _D),
)

TOTAL_KEYS = ("organization_id", "period_type", "start_date", "end_date", "is_active")
RATE_KEYS = ("organization_id", "period_type", "start_date", "end_date", "type")


def _export(value: T.DataType) -> T.StructType:
    return _struct(
        ("organization_id", _L),
        ("type", _S),
        ("period_type", _S),
        ("start_date", _DT),
        ("end_date", _DT),
        ("value", value),
    )


TOTALS_EXPORT = _export(_L)
RATES_EXPORT = _export(_D)
