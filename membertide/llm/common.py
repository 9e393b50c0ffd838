"""What the operators share: scratch tables, bounded Arrow chunks, size-checked joins, hashing."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membertide.sources.shared import delete_folder, shared_dir

#: Text that a Python worker takes up at once, in bytes; a longer single text comes alone.
CHUNK_BYTES = 2 << 20
#: Rows, and bytes, up to which a measured side of a join is broadcast. Beyond them it is shuffled.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 32 << 20
#: Spark's setting to delete a query's shuffle files at its end; else they stay until the driver's garbage collector runs.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="membertide-"), "membertide.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


class Scratch:
    """Tables written to the shared folder to cut lineage; ``close`` deletes them.

    A result that was built on them must be written, or no longer needed, by then.
    """

    _open: set[Scratch] = set()

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/membertide-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        Scratch._open.add(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, written. What the write shuffled goes when it has ended; the table is read instead."""
        path, had = self.path(name), self.spark.conf.get(SHUFFLE_CLEANUP, "false")
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, had)
        made = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(made)] = path
        return made

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing will read again, and have Spark clean up what the jobs behind them shuffled.

        Spark removes shuffle files once the driver has collected the objects that stand for them, which
        it may not do for a long time by itself.
        """
        for table in tables:
            delete_folder(self.spark, self.paths.pop(id(table)))
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def close(self) -> None:
        Scratch._open.discard(self)
        delete_folder(self.spark, self.root)

    @classmethod
    def close_all(cls) -> None:
        for scratch in list(cls._open):
            if scratch.spark.sparkContext._jsc is None or scratch.spark.sparkContext._jsc.sc().isStopped():
                cls._open.discard(scratch)
            else:
                scratch.close()


atexit.register(Scratch.close_all)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(side: DataFrame, width: int = 16) -> DataFrame:
    """``side`` (a written table) with a broadcast hint if its counted rows stay below both bounds.

    ``width``: bytes a row takes at most. Beyond the bounds Spark shuffles as it sees fit.
    """
    rows = side.count()
    return F.broadcast(side) if rows <= BROADCAST_ROWS and rows * width <= BROADCAST_BYTES else side


def extended(schema: T.StructType, **added: str) -> T.StructType:
    """A copy of ``schema`` with further fields, by their SQL types."""
    return T.StructType([*schema.fields, *(T.StructField(n, T._parse_datatype_string(t)) for n, t in added.items())])


def with_length(docs: DataFrame, text: str = "text") -> DataFrame:
    """A column ``n_chars`` of integers, if there is one, brought up to date with the text."""
    if isinstance(dict((f.name, f.dataType) for f in docs.schema).get("n_chars"), T.IntegralType):
        return docs.withColumn("n_chars", F.length(F.col(text)).cast(docs.schema["n_chars"].dataType))
    return docs


def split_join(left: DataFrame, right: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Join where both sides can compute ``on`` and ``right`` was grouped by what it is made of.

    The key is an expression, so the join gets exchanges of its own instead of the one that
    grouped ``right``, and adaptive execution can split a hot key of ``left``. Of columns that
    both have, the left one stays.
    """
    ours, theirs = left.withColumn("__join_key", on), right.withColumn("__right_key", on)
    theirs = theirs.drop(*[c for c in right.columns if c in left.columns])
    return ours.join(theirs, F.col("__join_key") == F.col("__right_key"), how).drop("__join_key", "__right_key")


def text_key(text: Column) -> Column:
    """With the id it tells rows apart that share the id but not the text; null has a key too."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def chunks(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in column ``text``, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, begin = np.cumsum(sizes), 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat_binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values``, ``counts[i]`` long, as one binary value each."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )
