"""Writers for stage outputs and the serving tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from membertide.operators.serving import upsert
from membertide.schemas import ALLTIME, APP, ORG, check_variant
from membertide.sources.readers import MONTH, month_number


def stage_path(root: str, stage: str, level: str, period_type: str) -> str:
    """Directory of one variant of a stage, e.g. ``<root>/rate_input/by-org/weekly``."""
    check_variant(level, period_type)
    if period_type == ALLTIME:
        return f"{root}/{stage}/{ALLTIME}"
    return f"{root}/{stage}/by-{'app' if level == APP else 'org'}/{period_type}"


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False, files: int | None = None) -> None:
    """Replace ``path`` with part files of text.

    ``files`` fixes their number, at the price of a shuffle; 1 merges a table into one file and
    suits the application's figures, whose size is bounded by the calendar. By default Spark's
    own partitions are written as they are.
    """
    if files is not None:
        df = df.repartition(files)
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)


def write_tsv(df: DataFrame, path: str, files: int | None = None) -> None:
    write_delimited(df, path, "\t", files=files)


def write_export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    if fmt == "csv":
        write_delimited(df, path, header=True)
    elif fmt in ("json", "parquet"):
        df.write.mode("overwrite").format(fmt).save(path)
    else:
        raise ValueError(f"{fmt} is not a known export format")


def ingest_interactions(interactions: DataFrame, path: str, months: bool = False) -> None:
    """Write interactions once as Parquet, with the BIGINT ``seq`` that tells their file order.

    ``seq`` was made where the rows were read, so nothing is shuffled; rows keep whatever
    clustering by date they came in. With ``months`` they lie in a folder per month (``readers.MONTH``), so that a run
    over some months reads those alone; input that is not ordered by date then makes a file per task and month.
    """
    if months:
        interactions = interactions.withColumn(MONTH, month_number(F.col("interaction_date")))
    writer = interactions.write.mode("overwrite")
    (writer.partitionBy(MONTH) if months else writer).parquet(path)


def read_version(spark: SparkSession, path: str, level: str | None = None) -> DataFrame:
    """A serving table's records, all or those of one level; the others' files are not read."""
    table = spark.read.parquet(path)
    return (table if level is None else table.filter(F.col("level") == level)).drop("level")


def write_version(
    spark: SparkSession, current: str | None, updates: DataFrame, keys: Sequence[str], new: str
) -> DataFrame:
    """Write the table at ``current``, upserted with ``updates``, to the path ``new``.

    The current version stays readable, and the caller moves on to ``new`` once all tables of
    the version are written (``publish``). Until then a run that failed may be repeated: it
    replaces what it left at ``new``. The first version has no ``current``. Records lie in
    a folder per level.
    """
    merged = updates if current is None else upsert(read_version(spark, current), updates, keys)
    level = F.when(F.col("organization_id").isNull(), APP).otherwise(ORG)
    merged.withColumn("level", level).write.mode("overwrite").partitionBy("level").parquet(new)
    return read_version(spark, new)


_PUBLISHED = "version STRING"


def published(spark: SparkSession, root: str) -> set[str]:
    """The serving versions below ``root`` that are complete; a run adds one."""
    try:
        found = spark.read.schema(_PUBLISHED).parquet(f"{root}/published").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {row.version for row in found}


def publish(spark: SparkSession, root: str, version: str) -> None:
    spark.createDataFrame([(version,)], _PUBLISHED).coalesce(1).write.mode("append").parquet(f"{root}/published")
