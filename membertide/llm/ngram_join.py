"""N-gram Jaccard join: size bands, hashed bitmaps, exact sorted-array intersection.

A document's set holds its distinct word shingles as 64-bit hashes. Sets are grouped into size bands. Two
sets of similarity s differ in at most a bounded number k of shingles, which depends on the band;
cutting the hash space into k + 1 segments leaves one segment at least in which they agree, so
the segments' contents are join keys that lose no link. A set with an empty segment takes its first shingles as keys
as well, and no key comes from an empty segment, so small sets do not meet by having nothing in common.
Sets that share a key, directly or by way of others, form a family.

1. Each set is linked to the set it shares most keys with, if their exact intersection allows.
2. What a family has left, members of different components, is compared in tiles of its size bands,
   split further where a band holds many sets or bytes: bit counts of hashed bitmaps bound the overlap of all
   pairs of a tile from above, and the pairs that pass are intersected exactly.

Components of both kinds of links are exact. A hot key costs a row per map batch and an edge per
set; equal sets are one node; a family that step 1 unites costs no comparison in step 2. Keys go to the exchange
as they are made, cut to 32 bits within their bucket: what they bring together by chance is compared
like anything else. Sets are made again from the texts where they are compared, in step 2 only
those of families that are not one yet. Sets are told apart by a 64-bit hash of their content.

Ids are taken as BIGINT. Null or empty text, or no words: no shingles, linked with nothing. With fewer words than a shingle
the whole sequence is one. Texts of any length are taken whole: a set is an array of one row. Repeated rows link
like any equal sets. A null id is never the smallest. Empty table: no rows. Only the id and the text are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membertide.llm.common import Scratch, chunks, mix, partitions, small, split_join, text_key
from membertide.llm.components import components
from membertide.llm.exchange import BUCKET_KEYS, bucketed, gathered, groups, windows, word_hashes

#: Sets of one band of one family that a tile compares with each other, and bytes of their bitmaps.
TILE_SETS = 2048
TILE_BYTES = 16 << 20
BAND_GROWTH = 1.4
#: Bits per shingle in a bitmap, at least.
BITMAP_DENSITY = 4


@dataclass(frozen=True)
class Bands:
    """Size bands for sets that link at ``percent`` or more."""

    percent: int = 90
    first: int = 9

    def upper(self, band: int) -> int:
        size = self.first
        for _ in range(band):
            size = max(size + 1, int(size * BAND_GROWTH))
        return size

    def of(self, sizes: np.ndarray) -> np.ndarray:
        edges, band = [self.first], 0
        while len(sizes) and edges[-1] < sizes.max():
            band += 1
            edges.append(self.upper(band))
        return np.searchsorted(np.array(edges), sizes, side="left")

    def reach(self, band: int) -> int:
        """The largest set that can link to one of the band."""
        return self.upper(band) * 100 // self.percent

    def segments(self, band: int) -> int:
        """One more than the largest symmetric difference of linked sets, the smaller in the band.

        With union u and intersection i, 100 i >= p u; a + b = u + i and the difference is u - i.
        """
        return (self.upper(band) + self.reach(band)) * (100 - self.percent) // (100 + self.percent) + 1

    def bits(self, band: int) -> int:
        return 1 << (BITMAP_DENSITY * self.upper(band) - 1).bit_length()

    def linked(self, common, left, right):
        return 100 * common >= self.percent * (left + right - common)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes."""
    words = [(t or "").encode().lower().split() for t in texts]
    codes = word_hashes(words)
    every = windows(codes, width)
    sets, begin = [], 0
    for ws in words:
        end = begin + len(ws)
        if len(ws) >= width:
            sets.append(np.unique(every[begin : end - width + 1]))
        elif ws:
            sets.append(windows(codes[begin:end], len(ws)) ^ np.uint64(len(ws)))
        else:
            sets.append(codes[:0])
        begin = end
    return sets


@lru_cache
def _segments(bands: Bands, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the segments of a band meet, and a number for each."""
    count = bands.segments(band)
    edges = np.array([i * (1 << 64) // count for i in range(1, count)], np.uint64)
    return edges, mix(np.arange(count, dtype=np.uint64) + np.uint64(band << 32))


def segment_keys(shingles: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    """A key per segment of the hash space: the content of the set there.

    A set with an empty segment takes its first shingles as keys instead of empty segments, enough that linked
    sets share one of them.
    """
    edges, salt = _segments(bands, band)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(shingles), dtype=np.uint64)))
    at = np.concatenate(([0], np.searchsorted(shingles, edges), [len(shingles)])).astype(np.int64)
    keys, filled = mix((sums[at[1:]] - sums[at[:-1]]) ^ salt), at[1:] > at[:-1]
    if filled.all():
        return keys
    first = shingles[: len(shingles) + 1 + -bands.percent * len(shingles) // 100]
    return np.concatenate((keys[filled], mix(first ^ np.uint64(0x8EBC6AF09C88C6E3))))


def bitmap(shingles: np.ndarray, bits: int) -> bytes:
    marked = np.zeros(bits, bool)
    marked[(shingles & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marked, bitorder="little").tobytes()


def set_keys(own: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    """All keys of a set of the band: also those of the band below, if it can link to a set there."""
    found = [segment_keys(own, band, bands)]
    if band and len(own) <= bands.reach(band - 1):
        found.append(segment_keys(own, band - 1, bands))
    return np.concatenate(found)


def set_node(own: np.ndarray) -> int:
    """The hash of a set's content."""
    total = np.add.reduce(mix(own ^ np.uint64(0xA0761D6478BD642F)))
    return int(mix(np.array([total ^ np.uint64(len(own))], np.uint64)).view(np.int64)[0])


def signatures(docs: DataFrame, width: int, bands: Bands, doc_id: str, text: str) -> DataFrame:
    """(doc_id, version, n, node, n_keys): node is the hash of the set, null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 2):
            sets = shingle_sets(chunk.column(2).to_pylist(), width)
            sizes = np.array([len(s) for s in sets], np.int64)
            nodes = [set_node(own) if len(own) else None for own in sets]
            made = [pa.array(sizes), pa.array(nodes, pa.int64()), pa.array(_key_counts(sizes, bands))]
            yield pa.RecordBatch.from_arrays([chunk.column(0), chunk.column(1), *made], names=["doc_id", "version", "n", "node", "n_keys"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_key(F.col(text)).alias("version"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, version bigint, n bigint, node bigint, n_keys bigint")


def _key_counts(sizes: np.ndarray, bands: Bands) -> np.ndarray:
    """About how many keys sets of these sizes have."""
    each = np.array([bands.segments(b) for b in range(int(bands.of(sizes).max(initial=0)) + 1)], np.int64)
    return np.where(sizes > 0, 2 * each[bands.of(sizes)], 0)


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per key its smallest node; and an edge from each other node to it. Keys and nodes come back once each."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    group, begins = groups(keys)
    centre = nodes[begins][group]
    apart = nodes != centre
    return keys[begins], nodes[begins], nodes[apart], centre[apart]


def _counted(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(a)))
    return pa.RecordBatch.from_arrays([pa.array(a[begins]), pa.array(b[begins]), pa.array(counts)], names=["a", "b", "shared"])


def key_edges(docs: DataFrame, total: int, width: int, bands: Bands, text: str) -> DataFrame:
    """(a, b, shared): sets that share keys, as stars around each key's smallest set. ``total``: keys there are."""
    buckets = max(partitions(docs.sparkSession), int(total // BUCKET_KEYS) + 1)
    packed = {"keys": np.dtype("<u4"), "nodes": np.dtype("<i8")}
    settled = {"keys": np.dtype("<i8"), "nodes": np.dtype("<i8")}

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 0):
            sets = [s for s in shingle_sets(chunk.column(0).to_pylist(), width) if len(s)]
            if not sets:
                continue
            levels = bands.of(np.array([len(s) for s in sets])).tolist()
            made = [set_keys(s, band, bands) for s, band in zip(sets, levels)]
            nodes = np.repeat(np.array([set_node(s) for s in sets], np.int64), [len(k) for k in made])
            # what this batch can settle needs no exchange but that of the edges
            keys, nodes, a, b = _stars(np.concatenate(made), nodes)
            yield bucketed(keys, buckets, {"keys": (keys >> np.uint64(32)).astype("<u4"), "nodes": nodes})
            if len(a):
                yield bucketed(a.view(np.uint64), buckets, {"keys": a, "nodes": b}, kind=1)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        found = gathered(_of_kind(rows, 0), packed) | gathered(_of_kind(rows, 1), settled)
        keys, nodes = found.get(0, (np.zeros(0, np.uint32), np.zeros(0, np.int64)))
        _, _, a, b = _stars(keys, nodes)
        if 1 in found:
            a, b = np.concatenate((a, found[1][0])), np.concatenate((b, found[1][1]))
        if len(a):
            yield _counted(a, b)

    dealt = docs.select(F.col(text).alias("text")).mapInArrow(scatter, "bucket int, kind int, keys binary, nodes binary").repartitionById(buckets, "bucket")
    edges = dealt.select("kind", "keys", "nodes").mapInArrow(gather, "a bigint, b bigint, shared bigint")
    return edges.groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def _of_kind(rows: list[pa.RecordBatch], kind: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        yield batch.filter(pc.equal(batch.column("kind"), kind))


def sets_of(docs: DataFrame, wanted: DataFrame, width: int, doc_id: str, text: str, bits: Bands | None = None) -> DataFrame:
    """The sets (sorted hashes, eight bytes each) of the wanted (doc_id, version, node, ...), with their further columns.

    ``bits`` asks for bitmaps as well. Rows that repeat give a set each.
    """
    further = [f for f in wanted.schema if f.name not in ("doc_id", "version")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 0):
            sets = shingle_sets(chunk.column(0).to_pylist(), width)
            made = [pa.array([s.tobytes() for s in sets], pa.binary())]
            if bits:
                levels = bits.of(np.array([len(s) for s in sets])).tolist()
                made.append(pa.array([bitmap(s, bits.bits(band)) for s, band in zip(sets, levels)], pa.binary()))
            yield pa.RecordBatch.from_arrays([*chunk.columns[1:], *made], names=[*chunk.schema.names[1:], "shingles", "bitmap"][: chunk.num_columns - 1 + len(made)])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), text_key(F.col(text)).alias("of"), F.col(text).alias("text"))
    match = rows.doc.eqNullSafe(wanted.doc_id) & (rows.of == wanted.version)
    schema = T.StructType([*further, *(T.StructField(c, T.BinaryType()) for c in ("shingles", "bitmap")[: 2 if bits else 1])])
    return rows.join(small(wanted, 32), match).select("text", *[f.name for f in further]).mapInArrow(run, schema)


def linked_pairs(pairs: DataFrame, bands: Bands) -> DataFrame:
    """Of (a, b, left, right) the pairs whose sets link, by intersection of sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, "<u8"), np.frombuffer(right, "<u8")
                keep.append(bool(bands.linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, bands: Bands) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return linked_pairs(pairs.join(left, "a").join(right, "b"), bands)


def _bit_rows(maps: list[bytes], bits: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit integers, larger ones folded to ``bits``."""
    out = np.zeros((len(maps), max(1, bits // 64)), np.uint64)
    for i, raw in enumerate(maps):
        row = np.frombuffer(raw, np.uint8)
        while len(row) * 8 > bits:
            row = row[: len(row) // 2] | row[len(row) // 2 :]
        out[i].view(np.uint8)[: len(row)] = row
    return out


def tile_pairs(sizes, nodes, roots, own, maps, side, bits: int, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (smaller node first) of different components that the bitmaps do not rule out. ``own``: in the tile's band.

    ``side``: 1 and 2 for the two parts of a tile, which are compared with each other, or 0 for
    the one part of a tile on the diagonal. Of a pair at least one is of the band.
    """
    rows = _bit_rows(maps, bits)
    ones = np.bitwise_count(rows).sum(axis=1, dtype=np.int64)
    left = np.flatnonzero(side < 2)
    right = np.flatnonzero(side != 1)
    found, with_ = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in left.tolist():
        other = right[(roots[right] != roots[i]) & (own[right] | own[i])]
        if side[i] == 0:
            other = other[other > i]
        low, high = np.minimum(sizes[other], sizes[i]), np.maximum(sizes[other], sizes[i])
        other = other[100 * low >= bands.percent * high]
        # bits in which they differ; lost and gained ones differ as the ones do
        apart = np.bitwise_count(rows[other] ^ rows[i]).sum(axis=1, dtype=np.int64)
        lost = (apart + ones[i] - ones[other]) // 2
        bound = np.minimum(sizes[i] - lost, sizes[other] - (apart - lost))
        passed = other[bands.linked(bound, sizes[i], sizes[other])]
        found.append(nodes[passed])
        with_.append(np.full(len(passed), nodes[i], np.int64))
    a, b = np.concatenate(with_), np.concatenate(found)
    return np.minimum(a, b), np.maximum(a, b)


def residual_pairs(members: DataFrame, scratch: Scratch, bands: Bands) -> DataFrame:
    """From (family, root, node, n, bitmap, band): pairs of different components to be verified."""
    reach = F.get(F.array(*[F.lit(bands.reach(b)) for b in range(MOST_BANDS)]), F.col("band") - 1)
    levels = F.when((F.col("band") > 0) & (F.col("n") <= reach), F.array(F.col("band"), F.col("band") - 1)).otherwise(F.array("band"))
    placed = scratch.table(members.select("*", F.explode(levels).alias("level")), "placed")
    parts = placed.groupBy("family", "level").agg(F.ceil(F.greatest(F.count("*") / TILE_SETS, F.sum(F.length("bitmap")) / TILE_BYTES)).cast("int").alias("parts"), F.min("root").alias("least"), F.max("root").alias("most"))
    split = placed.join(parts.filter("least <> most").drop("least", "most"), ["family", "level"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    other = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = other.select(
        "family", "level", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
        F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2).alias("side"),
        "root", "node", "n", "bitmap", (F.col("band") == F.col("level")).alias("own"),
    )

    def compare(table: pa.Table) -> pa.Table:
        column = {c: table.column(c).to_numpy() for c in ("n", "node", "root", "own", "side")}
        bits = bands.bits(table.column("level")[0].as_py())
        maps = table.column("bitmap").to_pylist()
        pairs = tile_pairs(column["n"], column["node"], column["root"], column["own"].astype(bool), maps, column["side"], bits, bands)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    # dealt by tile: the join's partitions would keep a family's tiles in one task
    dealt = tiles.repartition("family", "level", "p", "q")
    return dealt.groupBy("family", "level", "p", "q").applyInArrow(compare, "a bigint, b bigint").distinct()


#: Bands up to sets of many billions.
MOST_BANDS = 64


def contracted(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The links (a, b) between different components, as links of their roots."""
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    both = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = both.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    return ends.filter("a <> b").distinct()


def join_components(
    docs: DataFrame, scratch: Scratch, width: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, version, n, node, component_id) of every row; component_id is the smallest doc_id."""
    bands = Bands(percent)
    signed = scratch.table(signatures(docs, width, bands, doc_id, text), "signed")
    total = signed.agg(F.sum("n_keys")).first()[0] or 0
    edges = scratch.table(key_edges(docs, total, width, bands, text), "edges")
    involved = scratch.table(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct(), "involved")
    one_each = signed.join(involved, "node").groupBy("node").agg(F.min(F.struct("doc_id", "version")).alias("row"), F.first("n").alias("n"))
    wanted = scratch.table(one_each.select("node", "n", "row.*"), "wanted")

    # a set goes to the set it shares most keys with; the sets in the middle are few
    nearest = scratch.table(edges.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b")), "nearest")
    lone = wanted.select("doc_id", "version", F.col("node").alias("a")).join(nearest, "a").select("doc_id", "version", "a", "b")
    middle = wanted.select("doc_id", "version", F.col("node").alias("b")).join(nearest.select("b").distinct(), "b").select("doc_id", "version", "b")
    left = sets_of(docs, scratch.table(lone, "lone"), width, doc_id, text).withColumnRenamed("shingles", "left")
    right = sets_of(docs, scratch.table(middle, "middle"), width, doc_id, text).dropDuplicates(["b"]).withColumnRenamed("shingles", "right")
    links = scratch.table(linked_pairs(split_join(left, right, F.col("b").cast("decimal(20,0)")), bands), "links")
    del left, right
    scratch.drop(nearest)
    roots = components(links, scratch)

    # families are found among components, so what is united already adds no edge
    apart = scratch.table(contracted(edges, roots), "apart")
    families = components(apart, scratch).select(F.col("node").alias("root"), F.col("root").alias("family"))
    joined = wanted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rest = scratch.table(joined.join(families, "root").select("doc_id", "version", "node", "n", "root", "family"), "rest")
    sets = scratch.table(sets_of(docs, rest, width, doc_id, text, bands).dropDuplicates(["node"]), "sets")
    upper = [bands.upper(b) for b in range(MOST_BANDS)]
    members = sets.withColumn("band", F.size(F.filter(F.array(*map(F.lit, upper)), lambda u: u < F.col("n"))))
    pairs = scratch.table(residual_pairs(members.drop("shingles"), scratch, bands), "pairs")
    more = scratch.table(verified(pairs, sets, bands), "more")
    scratch.drop(sets, pairs)
    further = components(scratch.table(contracted(more, roots), "further"), scratch)
    further = further.select(F.col("node").alias("had"), F.col("root").alias("now"))

    rows = signed.drop("n_keys").join(roots, "node", "left").withColumn("had", F.coalesce("root", "node"))
    rows = rows.join(further, "had", "left").withColumn("root", F.coalesce("now", "had"))
    smallest = rows.filter("node IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    found = split_join(rows, smallest, F.col("root").cast("decimal(20,0)"), "left").withColumn("component_id", F.coalesce("smallest", "doc_id"))
    return found.select("doc_id", "version", "n", "node", "component_id")


def keep_one(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; empty sets all stay.

    Of rows that share the smallest id one stays, by the text's hash; rows equal in id and text
    too are one document.
    """
    found = join_components(docs, scratch, doc_id=doc_id, text=text, **options)
    found = scratch.table(found.distinct(), "found")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version")  # null ids last
    first = found.filter("node IS NOT NULL").groupBy("component_id").agg(F.min(place).alias("stay"))
    gone = found.filter("node IS NOT NULL").join(first, found.component_id.eqNullSafe(first.component_id))
    gone = gone.filter(~place.eqNullSafe(F.col("stay"))).select(F.col("doc_id").alias("__gone_id"), F.col("version").alias("__gone_version"))
    gone = scratch.table(gone, "gone")
    match = F.col(f"`{doc_id}`").eqNullSafe(F.col("__gone_id")) & (text_key(F.col(f"`{text}`")) == F.col("__gone_version"))
    return docs.join(small(gone, 24), match, "left_anti")
