"""Tables in parts, with versions that share the folders they do not change.

A version is a manifest: a row per part with the folder that holds it. ``update`` reads the parts
its rows belong to, merges, writes those parts anew below the version's own folder, and lists
the others where they were. The manifest is written last and makes the version; until then a run
that failed may be repeated, and replaces what it left. A version that has its manifest is never
written again. Files of an older version are never touched, so its readers go on undisturbed.

A part has one file, however many tasks merged its rows; only where one is large does Spark deal it, and parts that share
its exchange partition, to several tasks. So files grow with the parts and the bytes, not with parts times tasks.

A part is told by an expression of a row, whose values are short names of letters, digits and
dashes, and few: they follow the calendar, not the data. Their list is all the driver sees.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFEST = "part STRING, folder STRING"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def manifest(spark: SparkSession, root: str, version: str) -> dict[str, str] | None:
    """Folder of each part, or None if there is no such version."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/{version}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return {row.part: row.folder for row in rows}


def _known(spark: SparkSession, root: str, version: str) -> dict[str, str]:
    found = manifest(spark, root, version)
    if found is None:
        raise ValueError(f"version {version!r} does not exist")
    return found


def read(spark: SparkSession, root: str, version: str, schema: T.StructType, only: Collection[str] | None = None) -> DataFrame:
    """The rows of a version, of all parts or those in ``only``; other parts' files are not opened."""
    parts = _known(spark, root, version)
    folders = sorted(f"{root}/{folder}" for part, folder in parts.items() if only is None or part in only)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def written(spark: SparkSession, root: str, version: str) -> set[str]:
    """The parts that this version wrote itself."""
    return {part for part, folder in _known(spark, root, version).items() if folder.startswith(f"data/{version}/")}


def update(
    spark: SparkSession, root: str, previous: str | None, version: str, rows: DataFrame, part: Column, merge: Merge, schema: T.StructType,
    dropped: Collection[str] = (),
) -> set[str]:
    """Write ``version`` from ``previous`` and ``rows``; returns the parts it rewrote.

    ``merge`` makes a part's new rows from its current ones and the new ones; it must leave some. Parts in
    ``dropped`` that have no new rows are gone. ``rows`` is read twice, so it should be a written table.
    """
    if manifest(spark, root, version) is not None:
        raise ValueError(f"version {version!r} exists and stays as it is")
    before = _known(spark, root, previous) if previous is not None else {}
    touched = {r.part for r in rows.select(part.alias("part")).distinct().collect()}
    if touched:
        current = read(spark, root, previous, schema, touched) if previous is not None else spark.createDataFrame([], schema)
        merged = merge(current, rows.select(*schema.names)).select(*schema.names)
        # a part's rows come together, or each task would write a file for each part; a large part is split again
        dealt = merged.withColumn("part", part).hint("rebalance", "part")
        dealt.write.mode("overwrite").partitionBy("part").parquet(f"{root}/data/{version}")
    kept = [(name, folder) for name, folder in sorted(before.items()) if name not in touched and name not in dropped]
    listed = kept + [(name, f"data/{version}/part={name}") for name in sorted(touched)]
    spark.createDataFrame(listed, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/{version}")
    return touched.union(dropped)
