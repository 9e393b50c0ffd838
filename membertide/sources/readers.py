"""Typed readers. No schema is ever inferred."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membertide import schemas
from membertide.functions.periods import label_bounds
from membertide.operators.cleaning import clean_interactions
from membertide.operators.dedup import SEQ
from membertide.operators.totals import Totals

EXPORT_FORMATS = ("csv", "json", "parquet")


def read_export(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    *,
    lenient: bool = False,
    multiline: bool = False,
    extra: tuple[T.StructField, ...] = (),
) -> DataFrame:
    """Read a header CSV, JSON or Parquet export, columns matched by name.

    Text formats are read as strings and cast, so a value of the wrong type fails the read, or
    becomes NULL with ``lenient``; ``rejected_rows`` gives the rows concerned. An integer may be
    written with a fraction of zeros, as ``12.0``. ``multiline`` is for JSON files that hold one
    array; such a file cannot be split.
    """
    fields = [*schema.fields, *extra]
    raw = _raw_export(spark, path, fields, fmt, multiline)
    return raw.select(*(_typed(raw, f, lenient).alias(f.name) for f in fields))


def rejected_rows(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", *, multiline: bool = False
) -> DataFrame:
    """The rows, as they stand in the file, in which ``lenient`` turns a value into NULL."""
    raw = _raw_export(spark, path, schema.fields, fmt, multiline)
    lost = (F.col(f.name).isNotNull() & _typed(raw, f, True).isNull() for f in schema.fields)
    return raw.select(*schema.names).filter(reduce(lambda a, b: a | b, lost))


def _raw_export(
    spark: SparkSession, path: str, fields: Sequence[T.StructField], fmt: str, multiline: bool
) -> DataFrame:
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    elif fmt == "json":
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
        raw = spark.read.schema(text).option("multiLine", multiline).option("mode", "FAILFAST").json(path)
    elif fmt == "csv":
        # Column names come from the header line of one file; every other file must agree.
        raw = (
            spark.read.option("header", True)
            .option("inferSchema", False)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .csv(path)
        )
    else:
        raise ValueError(f"{fmt} is not one of {', '.join(EXPORT_FORMATS)}")
    return raw


def _typed(raw: DataFrame, field: T.StructField, lenient: bool) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.LongType) and isinstance(raw.schema[field.name].dataType, T.StringType):
        # never by way of DOUBLE, which has no room for large ids
        column = F.regexp_replace(F.trim(column), r"\.0*$", "")
    return column.try_cast(field.dataType) if lenient else column.cast(field.dataType)


def read_therapists(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    return read_export(spark, path, schemas.THERAPIST, fmt, **options)


#: Folder of an ingested month: 202403 for March 2024, null for rows without a date.
MONTH = "month"


def month_number(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def read_months(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Ingested interactions of the months from ``first`` to ``last`` (as 202403); other months' files are not listed in the scan."""
    schema = T.StructType([*schemas.INTERACTION.fields, T.StructField(SEQ, T.LongType()), T.StructField(MONTH, T.IntegerType())])
    return spark.read.schema(schema).parquet(path).filter(F.col(MONTH).between(first, last)).drop(MONTH)


def read_interactions(
    spark: SparkSession, path: str, fmt: str = "csv", sequence: str | None = None, clean: bool = False, **options
) -> DataFrame:
    """Interactions with ``seq``, the row order that keep-last goes by.

    ``sequence`` names a unique BIGINT column that rises with file order. Without one, ``seq``
    is made from the rows' places in the files. ``clean`` leaves out the rows that no figure
    counts before the order is made.
    """
    if sequence is not None:
        field = T.StructField(sequence, T.LongType())
        df = read_export(spark, path, schemas.INTERACTION, fmt, extra=(field,), **options)
        return df.withColumnRenamed(sequence, SEQ)
    df = read_export(spark, path, schemas.INTERACTION, fmt, **options)
    return with_file_order(clean_interactions(df) if clean else df, fmt)


#: Bits of ``seq`` below the file's rank: files of up to 8 TB, and a million of them.
PLACE_BITS = 43
#: Files up to which their ranks are broadcast; their paths are in the driver's listing anyway.
RANKED_FILES = 1 << 20


def with_file_order(df: DataFrame, fmt: str = "csv") -> DataFrame:
    """Add ``seq``, a BIGINT, to a frame read straight from files, with no shuffle.

    It is the file's rank by path, then the row's place in the file. Parquet knows the row. In text
    the place is the split's byte offset plus the rows read before in the partition: a row
    takes a byte at least, and Spark gives every split but a file's last a partition of its own,
    so places rise through the file.
    """
    files = sorted(df.inputFiles())
    if len(files) > RANKED_FILES:
        raise ValueError(f"more than {RANKED_FILES} files; name a column by sequence=")
    slashes = lambda path: F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")
    ranks = df.sparkSession.createDataFrame(list(zip(files, range(len(files)))), "ranked_file STRING, file_rank BIGINT")
    ranks = F.broadcast(ranks.withColumn("ranked_file", slashes("ranked_file")))
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    place = (
        F.col("_metadata.row_index")
        if fmt == "parquet"
        else F.col("_metadata.file_block_start") + in_partition
    )
    placed = df.withColumns({"in_file": slashes("_metadata.file_path"), "place": place})
    rank = F.coalesce("file_rank", F.raise_error(F.lit("a file that was not listed")).cast("bigint"))
    joined = placed.join(ranks, F.col("in_file") == F.col("ranked_file"), "left")
    seq = F.shiftleft(rank, PLACE_BITS).bitwiseOR(F.col("place"))
    return joined.withColumn(SEQ, seq).drop("in_file", "place", "ranked_file", "file_rank")


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Read a headerless file, or a directory of part files, by column position."""
    return spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST").csv(path)


def read_total_all(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.TOTAL_ALL, "\t")


def read_org_sizes(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.TOTAL_PER_ORG, "\t").select("organization_id", "total_thers_in_org")


def read_totals(spark: SparkSession, all_path: str, per_org_path: str) -> Totals:
    """Totals from the files of an earlier run; of the all-time file the first row counts."""
    row = read_total_all(spark, all_path).limit(1)
    start, end = label_bounds(F.col("all_time_period"), schemas.ALLTIME)
    alltime = row.select(
        start.alias("period_start"),
        end.alias("period_end"),
        F.col("all_time_thers").alias("total_ther"),
        "all_time_period",
    )
    return Totals(alltime, read_org_sizes(spark, per_org_path).withColumnRenamed("total_thers_in_org", "total_ther"))


def read_therapist_input(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.THERAPIST_INPUT)


def read_interaction_input(spark: SparkSession, path: str, level: str, period_type: str) -> DataFrame:
    return read_delimited(spark, path, schemas.INTERACTION_INPUT[level, period_type])


def read_active(spark: SparkSession, path: str, level: str) -> DataFrame:
    return read_delimited(spark, path, schemas.active(level), "\t")


def read_rate_input(spark: SparkSession, path: str, level: str) -> DataFrame:
    return read_delimited(spark, path, schemas.rate_input(level))


def read_rate_output(spark: SparkSession, path: str, level: str) -> DataFrame:
    return read_delimited(spark, path, schemas.rate_output(level))


def read_totals_export(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    return read_export(spark, path, schemas.TOTALS_EXPORT, fmt, **options)


def read_rates_export(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    return read_export(spark, path, schemas.RATES_EXPORT, fmt, **options)
