"""Token ids in binary shards, found by key through a minimal perfect hash.

``write`` encodes each text where it is read, deals the id payloads by ranges of the document id,
and writes shards of about ``SHARD_TOKENS`` ids in ascending order of the id. A shard is one
row of a Parquet file with binary columns, so any store Spark writes to will do, and the
commit of the write is Spark's. A range has a folder of its own, so that a reader of one range lists no
other. Ids of a vocabulary below 65,536 take two bytes. The ranges follow the measured size of the
texts; their bounds come from a sample by hash, which decides sizes alone, and are by id and a row's
place in the input, so that rows of one id, or without any, are split like all others.

Each shard has a minimal perfect hash over its distinct keys: bit arrays level by level, where a
key whose bit is its own is placed and the others go on to the next; a key's slot is the rank of
its bit. The slot holds a fingerprint, the first document and the number of documents under the
key; document bounds give offsets into the payload. ``lookup`` finds a key's range among the bounds and its shards
by the ids they begin and end with, reads the files of those ranges and shards only, and takes
constant time in each. A key that is absent is told by the fingerprint, or by 32 bits' chance.

Ids are taken as BIGINT. Null or empty text: the end id alone. A very long text is a shard of its
own; it is encoded at once, by its words. Null keys come first in the order; they are read back, but
cannot be looked up. Rows that share a key follow one another, and a lookup returns each of them.
Empty table: no shards. Columns other than id and text are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from membertide.llm.common import chunks, flat_binary, mix, partitions, small
from membertide.llm.tokens import default_tokenizer, encoder

END_ID = 2
SHARD_TOKENS = 1 << 19
#: Bytes of text in a range, about; and sampled rows per range.
PART_BYTES = 256 << 20
SAMPLE = 64
#: Shards in a file.
FILE_SHARDS = 16
#: Ranges and shards that a lookup names in its filters; beyond them it joins.
NAMED = 2000
GAMMA = 2.0
#: A level is not worth it below so many bits.
LEAST_BITS = 64

SLOT = np.dtype([("fingerprint", "<u4"), ("first", "<u4"), ("docs", "<u4")])

SHARD_SCHEMA = (
    "part int, shard int, n_docs int, n_tokens bigint, low bigint, high bigint, width int, "
    "doc_ids array<bigint>, bounds binary, levels array<binary>, sizes array<int>, slots binary, payload binary"
)
_ARROW = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("low", pa.int64())]
    + [("high", pa.int64()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("bounds", pa.binary())]
    + [("levels", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("slots", pa.binary()), ("payload", pa.binary())]
)


class PerfectHash:
    """A minimal perfect hash over distinct unsigned 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = [np.concatenate(([0], np.cumsum(bits))) for bits in levels]
        self.bases = np.concatenate(([0], np.cumsum([r[-1] for r in self.ranks]))).astype(np.int64)

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (mix(keys ^ salt) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys):
            size = max(LEAST_BITS, int(GAMMA * len(keys)))
            at = cls._at(keys, len(levels), size)
            taken = np.bincount(at, minlength=size)
            levels.append(taken == 1)
            keys = keys[taken[at] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; an absent key gets any slot, or -1."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = self._at(keys[open_], level, len(bits))
            hit = bits[at]
            found[open_[hit]] = self.bases[level] + self.ranks[level][at[hit]]
            open_ = open_[~hit]
        return found


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(32)).astype("<u4")


def make_shard(part: int, shard: int, keys: list[int | None], ids: list[bytes], width: int) -> dict:
    """One shard from documents in ascending order of the key, nulls first; ids in ``width`` bytes each."""
    bounds = np.concatenate(([0], np.cumsum([len(x) // width for x in ids]))).astype("<i8")
    nulls = sum(k is None for k in keys)
    present = np.array(keys[nulls:], np.int64)
    distinct, first, count = np.unique(present, return_index=True, return_counts=True)
    hashed = distinct.view(np.uint64)
    perfect = PerfectHash.build(hashed)
    slots = np.zeros(len(distinct), SLOT)
    at = perfect.slots(hashed)
    slots["fingerprint"][at], slots["first"][at], slots["docs"][at] = fingerprints(hashed), first + nulls, count
    return {
        "part": part, "shard": shard, "n_docs": len(keys), "n_tokens": int(bounds[-1]),
        "low": int(present[0]) if len(present) else None, "high": int(present[-1]) if len(present) else None,
        "width": width, "doc_ids": keys, "bounds": bounds.tobytes(),
        "levels": [np.packbits(b).tobytes() for b in perfect.levels], "sizes": [len(b) for b in perfect.levels],
        "slots": slots.tobytes(), "payload": b"".join(ids),
    }


class Shard:
    """Access to one shard's row."""

    def __init__(self, row: dict):
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(row["levels"], row["sizes"])]
        self.perfect = PerfectHash(bits)
        self.slots = np.frombuffer(row["slots"], SLOT)
        self.bounds = np.frombuffer(row["bounds"], "<i8")
        self.payload = np.frombuffer(row["payload"], f"<u{row['width']}")

    def documents(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents under each key; 0 documents if it is absent."""
        hashed = keys.astype(np.int64).view(np.uint64)
        at = self.perfect.slots(hashed)
        slot = self.slots[np.maximum(at, 0)] if len(self.slots) else np.zeros(len(keys), SLOT)
        known = (at >= 0) & (slot["fingerprint"] == fingerprints(hashed))
        return slot["first"].astype(np.int64), np.where(known, slot["docs"], 0).astype(np.int64)

    def ids(self, document: int) -> np.ndarray:
        return self.payload[self.bounds[document] : self.bounds[document + 1]].astype("<u4")


_LEAST = 1 << 63


def _place(key: int | None, at: int) -> int:
    """Id (null first) and a row's place as one number in the same order."""
    return ((0 if key is None else key + _LEAST + 1) << 64) | at


def _range_bounds(rows: DataFrame, parts: int) -> list[int]:
    """Lower bounds of all ranges but the first, from a sample of (doc_id, at)."""
    if parts < 2:
        return []
    share = max(1, rows.count() // (SAMPLE * parts))
    sampled = rows.select("doc_id", "at").filter(F.pmod(F.xxhash64("at"), F.lit(share)) == 0)
    found = sorted({_place(*r) for r in sampled.limit(4 * SAMPLE * parts).collect()})
    return sorted({found[i * len(found) // parts] for i in range(1, parts)}) if found else []


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the shards of all documents to ``path``/shards and the ranges to ``path``/ranges."""
    spark, file = docs.sparkSession, tokenizer or default_tokenizer()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("at"), F.col(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(partitions(spark), size // PART_BYTES + 1)
    lower = _range_bounds(rows, parts)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(file)
        width = 2 if coder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        for chunk in chunks(batches, 2):
            ids, bounds = coder.flat(chunk.column(2), end_id)
            part = [bisect_right(lower, _place(*r)) for r in zip(*(chunk.column(i).to_pylist() for i in (0, 1)))]
            raw = flat_binary(ids.astype(f"<u{width}"), np.diff(bounds))
            widths = pa.array(np.full(len(part), width, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *chunk.columns[:2], raw, widths], names=["part", "doc_id", "at", "ids", "width"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, keys, ids, tokens, width = None, 0, [], [], 0, 2

        def made():
            return pa.RecordBatch.from_pylist([make_shard(part, shard, keys, ids, width)], schema=_ARROW)

        for batch in batches:
            for p, key, raw, w in zip(*(c.to_pylist() for c in batch.columns)):
                if keys and (p != part or tokens >= SHARD_TOKENS):
                    yield made()
                    shard, keys, ids, tokens = (shard + 1 if p == part else 0), [], [], 0
                part, width = p, w
                keys.append(key)
                ids.append(raw)
                tokens += len(raw) // w
        if keys:
            yield made()

    coded = rows.mapInArrow(encode, "part int, doc_id bigint, at bigint, ids binary, width int")
    dealt = coded.repartitionById(len(lower) + 1, "part").sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "at")
    shards = dealt.select("part", "doc_id", "ids", "width").mapInArrow(build, SHARD_SCHEMA)
    shards.withColumn("range", F.col("part")).write.option("maxRecordsPerFile", FILE_SHARDS).partitionBy("range").parquet(f"{path}/shards")
    ranges = [(i, str(x)) for i, x in enumerate([0, *lower])]
    spark.createDataFrame(ranges, "part int, lower string").coalesce(1).write.parquet(f"{path}/ranges")


_STORED = f"{SHARD_SCHEMA}, range int"


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards; a store without any has no folder for them."""
    try:
        return spark.read.schema(_STORED).parquet(f"{path}/shards")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STORED)


def _starts(shards: DataFrame) -> DataFrame:
    """Ids before each shard: sums within a part, and over the parts' totals, one row a part."""
    counts = shards.select("part", "shard", "n_tokens")
    parts = counts.groupBy("part").agg(F.sum("n_tokens").alias("n")).selectExpr(
        "part", "sum(n) OVER (ORDER BY part) - n AS part_start"
    )
    inner = counts.selectExpr("part", "shard", "sum(n_tokens) OVER (PARTITION BY part ORDER BY shard) - n_tokens AS shard_start")
    return inner.join(parts, "part").selectExpr("part", "shard", "part_start + shard_start AS before")


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """Every document with its start and ids, found through its shard's index."""
    shards = _shards(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard, keys = Shard(row), row["doc_ids"]
                nulls = sum(k is None for k in keys)
                first, count = shard.documents(np.unique(np.array(keys[nulls:], np.int64)))
                order = [*range(nulls), *(d for f, n in zip(first.tolist(), count.tolist()) for d in range(f, f + n))]
                ids = [shard.ids(d).tobytes() for d in order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]] * len(order), pa.int32()) for c in ("part", "shard")]
                    + [pa.array([keys[d] for d in order], pa.int64()), pa.array(shard.bounds[order], pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "shard", "doc_id", "inside", "ids"],
                )

    found = shards.select("part", "shard", "width", "doc_ids", "bounds", "levels", "sizes", "slots", "payload").mapInArrow(
        run, "part int, shard int, doc_id bigint, inside bigint, ids binary"
    )
    return found.select("part", "shard", "doc_id", "inside", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), "ids")


def with_start(found: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``found`` with ``start`` in place of the position inside the shard; reads no payload."""
    starts = _starts(_shards(spark, path))
    joined = found.join(starts, ["part", "shard"])
    return joined.withColumn("start", F.col("before") + F.col("inside")).drop("part", "shard", "inside", "before")


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of every distinct key in ``keys`` that is stored.

    Up to ``NAMED`` shards are named in the filter of the read, so no other file is opened. Keys are
    brought to the shards; payloads are exchanged only if the keys are too many to be broadcast.
    """
    lower = [int(r.lower) for r in spark.read.parquet(f"{path}/ranges").orderBy("part").collect()][1:]  # one row a range
    columns = ["part", "shard", "width", "bounds", "levels", "sizes", "slots", "payload"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (k, part)
                for k in batch.column(0).to_pylist()
                for part in range(bisect_right(lower, _place(k, 0)), bisect_right(lower, _place(k, (1 << 64) - 1)) + 1)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int32()))], names=["doc_id", "of"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard, asked = Shard(row), np.array(row["asked"], np.int64)
                first, count = shard.documents(asked)
                found = [(k, shard.ids(d).tobytes()) for k, f, n in zip(asked.tolist(), first.tolist(), count.tolist()) for d in range(f, f + n)]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.binary()))], names=["doc_id", "ids"])

    wanted = keys.select(F.col(key).cast("bigint").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    placed, stored = wanted.mapInArrow(place, "doc_id bigint, of int"), _shards(spark, path)
    ranges = [r.of for r in placed.select("of").distinct().limit(NAMED + 1).collect()]
    if len(ranges) <= NAMED:
        stored = stored.filter(F.col("range").isin(ranges))
    inside = (F.col("part") == F.col("of")) & F.col("doc_id").between(F.col("low"), F.col("high"))
    asked = stored.select("part", "shard", "low", "high").join(placed, inside).groupBy("part", "shard").agg(F.collect_list("doc_id").alias("asked"))
    named = asked.limit(NAMED + 1).collect()
    if len(named) <= NAMED:
        asked = small(spark.createDataFrame(named, "part int, shard int, asked array<bigint>"), 1 << 10)
        stored = stored.filter(F.col("shard").isin(sorted({r.shard for r in named})))
        known = [k for r in named for k in r.asked]
        stored = stored.filter((F.col("high") >= min(known)) & (F.col("low") <= max(known))) if known else stored.limit(0)
    return stored.select(*columns).join(asked, ["part", "shard"]).select(*columns, "asked").mapInArrow(find, "doc_id bigint, ids binary")
