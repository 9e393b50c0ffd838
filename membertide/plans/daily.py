"""Day by day: a run reads the new interactions only and renews what they touch.

What is kept from run to run, below ``root``, are tables in parts (``membertide.sources.parts``):

- ``state``: the last row per therapist and period, a part per period. Keeping the last row by ``seq`` can be
  repeated in any order, so new rows are merged into the parts of their periods alone;
- ``counts``: active therapists per period and organization, recounted for the parts that changed;
- ``totals`` and ``rates``: the serving records, a part per level, period type and year.
  Parts without a changed record keep their files.

A late row touches the periods of its date. ``seq`` must be one order over all runs (a column of the
source). Every step is a version of its own, and a run that failed is repeated with the same
arguments: steps that are done stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from membertide import schemas
from membertide.operators import serving
from membertide.operators.activity import counts_summary, last_rows, merged_rows, period_counts
from membertide.operators.cleaning import clean_interactions, clean_therapists
from membertide.operators.totals import count_totals
from membertide.plans.kpis import summary_rates
from membertide.schemas import ALLTIME, APP, COMPAT, ORG
from membertide.sources import parts


def period_part() -> Column:
    """``weekly-1997-03-10`` and the like; all time has one part."""
    start = F.coalesce(F.col("period_start").cast("string"), F.lit("all"))
    return F.concat(F.col("period_type"), F.lit("-"), start)


def record_part() -> Column:
    """``org-weekly-1997`` and the like, by the year a period begins in."""
    level = F.when(F.col("organization_id").isNull(), APP).otherwise(ORG)
    year = F.when(F.col("period_type") == ALLTIME, F.lit("all")).otherwise(F.year("start_date").cast("string"))
    return F.concat(level, F.lit("-"), F.col("period_type"), F.lit("-"), F.coalesce(year, F.lit("none")))


def add_interactions(spark: SparkSession, interactions: DataFrame, root: str, version: str, previous: str | None = None) -> set[str]:
    """Merge new interactions into the state, and recount; returns the touched periods' parts."""
    state, counts = f"{root}/state", f"{root}/counts"
    if parts.manifest(spark, state, version) is None:
        path = f"{root}/new/{version}"
        last_rows(clean_interactions(interactions)).select(*schemas.STATE.names).write.mode("overwrite").parquet(path)
        new = spark.read.schema(schemas.STATE).parquet(path)
        merge = lambda current, rows: merged_rows(current.unionByName(rows))
        parts.update(spark, state, previous, version, new, period_part(), merge, schemas.STATE)
    touched = parts.written(spark, state, version)
    if parts.manifest(spark, counts, version) is None:
        recounted = period_counts(parts.read(spark, state, version, schemas.STATE, touched))
        recounted.select(*schemas.COUNTS.names).write.mode("overwrite").parquet(f"{root}/recounted/{version}")
        rows = spark.read.schema(schemas.COUNTS).parquet(f"{root}/recounted/{version}")
        parts.update(spark, counts, previous, version, rows, period_part(), lambda current, new: new, schemas.COUNTS)
    return touched


def summary(spark: SparkSession, therapists: DataFrame, root: str, version: str) -> DataFrame:
    """All seven variants as ``kpis.summary`` has them, from the counts alone."""
    counts = parts.read(spark, f"{root}/counts", version, schemas.COUNTS)
    return counts_summary(counts, count_totals(clean_therapists(therapists)))


def _missing(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of ``left`` that ``right`` does not have; NULLs are equal."""
    same = reduce(lambda a, b: a & b, (F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}")) for n in left.columns))
    return left.alias("l").join(right.alias("r"), same, "left_anti")


def upsert_records(
    spark: SparkSession, root: str, previous: str | None, version: str, records: DataFrame, keys: tuple[str, ...], schema
) -> set[str]:
    """Upsert a written table of serving records; only parts with a new or changed record are rewritten."""
    changed = records if previous is None else _missing(records, parts.read(spark, root, previous, schema))
    merge = lambda current, new: serving.upsert(current, new, keys)
    return parts.update(spark, root, previous, version, changed, record_part(), merge, schema)


def replace_records(spark: SparkSession, root: str, previous: str | None, version: str, records: DataFrame, schema) -> set[str]:
    """Make a written table of records the new version; only parts that differ are rewritten or go."""
    if previous is None:
        return parts.update(spark, root, None, version, records, record_part(), lambda current, new: new, schema)
    current = parts.read(spark, root, previous, schema)
    different = _missing(records, current).union(_missing(current, records)).select(record_part().alias("part")).distinct()
    touched = {r.part for r in different.collect()}  # the calendar bounds their number
    rows = records.filter(record_part().isin(sorted(touched)))
    return parts.update(spark, root, previous, version, rows, record_part(), lambda current, new: new, schema, touched)


def serve(spark: SparkSession, therapists: DataFrame, root: str, version: str, previous: str | None = None, adjacency: str = COMPAT) -> None:
    """Bring the serving records up to the counts of ``version``: those a whole run would give, no others."""
    path = f"{root}/summary/{version}"
    summary(spark, therapists, root, version).write.mode("overwrite").parquet(path)
    figures = spark.read.parquet(path)
    for name, records, schema in (
        ("totals", serving.total_records(figures), schemas.TOTAL_RECORD),
        ("rates", serving.rate_records(summary_rates(figures, adjacency)), schemas.RATE_RECORD),
    ):
        if parts.manifest(spark, f"{root}/{name}", version) is None:
            records.select(*schema.names).write.mode("overwrite").parquet(f"{root}/records/{name}/{version}")
            made = spark.read.schema(schema).parquet(f"{root}/records/{name}/{version}")
            replace_records(spark, f"{root}/{name}", previous, version, made, schema)


def records(spark: SparkSession, root: str, name: str, version: str) -> DataFrame:
    """The serving records of a version; ``name`` is ``totals`` or ``rates``."""
    schema = {"totals": schemas.TOTAL_RECORD, "rates": schemas.RATE_RECORD}[name]
    return parts.read(spark, f"{root}/{name}", version, schema)


def run(
    spark: SparkSession, interactions: DataFrame, therapists: DataFrame, root: str, version: str,
    previous: str | None = None, adjacency: str = COMPAT,
) -> set[str]:
    """One day's run from new interactions to serving records; returns the touched periods' parts."""
    touched = add_interactions(spark, interactions, root, version, previous)
    serve(spark, therapists, root, version, previous, adjacency)
    return touched
