"""Exact removal of repeated byte strings by prefix-free parsing.

Texts are bytes and are parsed at triggers: a place is one if the rolling hash of the bytes from it on is
the smallest of some ``length - gram + 1`` places of a string of ``length`` bytes. Every such string
then holds a trigger, with ``gram`` bytes behind it, that its bytes alone decide (its anchor, the first
of the smallest), so equal strings are parsed alike wherever they stand. A trigger's phrase is what
all strings anchored at it can reach: ``length - gram`` bytes before it and ``length`` behind it.

1. Dictionary. Each trigger's gram and phrase are exchanged by their hashes. A phrase that stands earlier as well
   makes every string in it a repeat, so only its first place goes on. A gram with one phrase alone has
   nothing more to compare: its first place keeps its bytes. Highly repetitive text ends here.
2. Order. Where a gram has several phrases (at the edges of repeated stretches), each distinct
   phrase's strings are keyed by their dictionary part, the phrase's bytes from the string's start to the
   anchor, and their parse part, the bytes from the anchor on. Sorted by both, equal
   strings are neighbours, and all but the first in (document, start) order are repeats.

What is sorted is hashes of the two parts, for only equality over ``length`` bytes is asked: no suffix array of the
whole corpus is made. 64-bit hashes decide, in buckets dealt by other bits of their own.

Equal phrases, and equal strings, are settled within some megabytes of text before they are exchanged, so a passage
that a third of all documents share costs a row per batch. Texts beyond ``SLICE`` bytes are taken up in
slices that overlap, so memory is bounded for texts of any length.

Null or empty text: no bytes. Ids that are null or not unique: rows are ordered by id (null first) and
the text's hash, and rows equal in both are one document, which does not remove its own bytes
but for repeats inside it. Empty table: no rows. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import BROADCAST_BYTES, Scratch, chunks, mix, partitions, split_join, text_key
from membertide.llm.exchange import groups, pair
from membertide.llm.ranks import ranked
from membertide.llm.substring_dedup import slid

LENGTH = 100
SLICE = 1 << 20
#: Bytes that are parsed at once, and bytes whose triggers are settled before they are exchanged.
BUFFER = 1 << 18
BATCH = 4 << 20
#: Keys a bucket is to hold on average.
BUCKET = 1 << 20
ROLL = 8
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


class PrefixHash:
    """Hashes of any substring of a buffer, from sums of powers."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int):
        base = (0x9E3779B97F4A7C15 + 2 * seed) | 1
        if base not in self._powers or len(self._powers[base][0]) <= len(data):
            inverse = pow(base, -1, 1 << 64)
            size = max(len(data), BUFFER) + 1
            made = [np.cumprod(np.append(np.ones(1, np.uint64), np.full(size, b, np.uint64)), dtype=np.uint64) for b in (base, inverse)]
            self._powers[base] = made[0], made[1]
        self.up, self.down = self._powers[base]
        letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])

    def rolling(self, width: int) -> np.ndarray:
        return mix((self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width])


@dataclass
class Buffer:
    """Pieces of texts one after the other. Per piece: document, its first byte's place, and bounds in the buffer."""

    data: np.ndarray
    docs: np.ndarray
    base: np.ndarray  # place in its document of the piece's first byte
    begin: np.ndarray  # in the buffer; ends where the next begins
    end: np.ndarray
    own: np.ndarray  # places from .. on that are this piece's own, in the document
    until: np.ndarray
    extra: list  # a value per piece

    def piece(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, at, side="right") - 1


def buffers(rows: Iterator[tuple], length: int) -> Iterator[Buffer]:
    """(document, bytes, extra) as buffers; long texts in overlapping slices."""
    pieces, size = [], 0

    def made() -> Buffer:
        sizes = np.array([len(p[1]) for p in pieces])
        ends = np.cumsum(sizes)
        docs, base, own, until = (np.array([p[i] for p in pieces], np.int64) for i in (0, 2, 3, 4))
        data = np.frombuffer(b"".join(p[1] for p in pieces), np.uint8)
        return Buffer(data, docs, base, ends - sizes, ends, own, until, [p[5] for p in pieces])

    margin = 2 * length
    for doc, raw, extra in rows:
        for at in range(0, len(raw), SLICE):
            first, last = max(0, at - margin), min(len(raw), at + SLICE + margin)
            if last - first >= length:
                pieces.append((doc, raw[first:last], first, at, at + SLICE, extra))
                size += last - first
        if size >= BUFFER:
            yield made()
            pieces, size = [], 0
    if pieces:
        yield made()


class Parse:
    """A buffer's rolling hashes, strings and triggers."""

    def __init__(self, buffer: Buffer, length: int):
        self.buffer, self.length = buffer, length
        self.gram = max(1, length // 2)
        self.reach = length - self.gram  # bytes before an anchor
        self.hashes = PrefixHash(buffer.data, 1)
        n, roll = len(buffer.data), min(ROLL, self.gram)
        self.values = np.full(n, _MOST)
        self.values[: n - roll + 1] = self.hashes.rolling(roll) | np.uint64(1)
        # strings begin where their piece has room for them
        room = np.zeros(n + 1, np.int32)
        np.add.at(room, buffer.begin, 1)
        np.add.at(room, np.maximum(buffer.begin, buffer.end - length + 1), -1)
        self.valid = np.cumsum(room[: n - self.reach]) > 0
        self.least = slid(self.values, self.reach + 1, np.minimum)
        self.least[~self.valid] = 0
        pad = np.zeros(self.reach, np.uint64)
        self.triggers = np.flatnonzero(slid(np.concatenate((pad, self.least, pad)), self.reach + 1, np.maximum) == self.values)

    def owned(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of places in the buffer those their piece owns, with piece and place in the document."""
        piece = self.buffer.piece(at)
        place = at - self.buffer.begin[piece] + self.buffer.base[piece]
        keep = (place >= self.buffer.own[piece]) & (place < self.buffer.until[piece])
        return at[keep], piece[keep], place[keep]

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Gram, phrase, document and place of each trigger of its own."""
        at, piece, place = self.owned(self.triggers)
        before = np.minimum(at - self.buffer.begin[piece], self.reach)
        behind = np.minimum(self.buffer.end[piece] - at, self.length)
        phrase = pair(self.hashes.of(at - before, at + behind), (before * (self.length + 1) + behind).astype(np.uint64))
        return self.hashes.of(at, at + self.gram), phrase, self.buffer.docs[piece], place

    def strings(self, marked: np.ndarray, settled: np.ndarray):
        """Key, bucket hash, document and place of the strings anchored at ``marked`` places, but the ``settled`` ones."""
        flags = np.full(len(self.values), _MOST)
        flags[marked] = self.values[marked]
        at = np.flatnonzero(self.valid & ~settled[: len(self.valid)] & (slid(flags, self.reach + 1, np.minimum) == self.least))
        at, piece, place = self.owned(at)
        # the anchor: the first trigger of the smallest hash; places take the hashes' lowest bits
        bits = np.uint64((1 << len(self.values).bit_length()) - 1)
        known = np.sort((self.values[self.triggers] & ~bits) | self.triggers.astype(np.uint64))
        anchor = known[np.searchsorted(known, (self.least[at] & ~bits) | at.astype(np.uint64))] & bits
        anchor = anchor.astype(np.int64)
        key = pair(self.hashes.of(at, anchor), self.hashes.of(anchor, at + self.length))
        other = PrefixHash(self.buffer.data, 2)
        return key, other.of(at, at + self.length), self.buffer.docs[piece], place


# --- what is exchanged ------------------------------------------------------------------------------

_DEALT = "bucket int, kind int, n int, keys binary, checks binary, docs binary, places binary"
_ROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("keys", "checks", "docs", "places"))])
_REPLY = "doc bigint, repeats binary, mixed binary"
#: Kinds of rows: a gram's one phrase, a phrase of a gram with several, such a gram, a repeat, a string.
GRAM, PHRASE, SEVERAL, REPEAT, STRING = range(5)


def _planes(values: np.ndarray) -> bytes:
    """Integers byte by byte, so that the upper ones compress."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1)


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(width, -1).T).view(kind).ravel()


def _dealt(kind: int, bucket: np.ndarray, keys, checks, docs: np.ndarray, places: np.ndarray) -> list[dict]:
    """A row per bucket, in order of document and place."""
    order = np.lexsort((places, docs, bucket))
    bucket, docs, places = bucket[order], docs[order], places[order]
    keys, checks = (None if c is None else c[order] for c in (keys, checks))
    _, begins = groups(bucket)
    rows = []
    for b, e in zip(begins.tolist(), [*begins[1:].tolist(), len(bucket)]):
        own = docs[b:e]
        rows.append({
            "bucket": int(bucket[b]), "kind": kind, "n": e - b,
            "keys": b"" if keys is None else keys[b:e].tobytes(), "checks": b"" if checks is None else checks[b:e].tobytes(),
            "docs": _planes(np.diff(own, prepend=np.int64(0))), "places": _planes(places[b:e].astype("<i8")),
        })
    return rows


def _gathered(batches: Iterator[pa.RecordBatch]) -> dict[int, list[np.ndarray]]:
    """Per kind keys, checks, documents and places of a bucket."""
    parts: dict[int, list[list]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            own = parts.setdefault(row["kind"], [[], [], [], []])
            own[0].append(np.frombuffer(row["keys"], "<u4" if row["kind"] in (GRAM, SEVERAL) else "<u8"))
            own[1].append(np.frombuffer(row["checks"], "<u8"))
            own[2].append(np.cumsum(_from_planes(row["docs"], "<i8")))
            own[3].append(_from_planes(row["places"], "<i8"))
    return {kind: [np.concatenate(c) for c in own] for kind, own in parts.items()}


def _first_places(keys: list[np.ndarray], docs: np.ndarray, places: np.ndarray):
    """An order by keys, document and place; for it the group's number, and whether a place is after the group's first."""
    order = np.lexsort((places, docs, *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    group = np.cumsum(new) - 1
    begins = order[new]
    later = (docs[order] != docs[begins][group]) | (places[order] != places[begins][group])
    return order, group, new, later


def _replies(repeats: list[tuple], mixed: list[tuple]) -> pa.RecordBatch | None:
    """A row per document with its places, sorted."""
    columns = {}
    for number, parts in enumerate((repeats, mixed)):
        docs = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
        places = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])
        order = np.lexsort((places, docs))
        docs, places = docs[order], places[order]
        _, begins = groups(docs)
        for b, e in zip(begins.tolist(), [*begins[1:].tolist(), len(docs)]):
            columns.setdefault(int(docs[b]), [b"", b""])[number] = places[b:e].astype("<i8").tobytes()
    if not columns:
        return None
    known = sorted(columns)
    arrays = [pa.array(known, pa.int64()), *(pa.array([columns[d][i] for d in known], pa.binary()) for i in (0, 1))]
    return pa.RecordBatch.from_arrays(arrays, names=["doc", "repeats", "mixed"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(document, bytes, further columns) row by row."""
    for chunk in chunks(batches, 1):
        further = [chunk.column(i).to_pylist() for i in range(2, chunk.num_columns)]
        yield from zip(chunk.column(0).to_pylist(), ((t or "").encode() for t in chunk.column(1).to_pylist()), zip(*further) if further else [()] * chunk.num_rows)


def _batched(found: Iterator[tuple[int, tuple[np.ndarray, ...]]]) -> Iterator[list[np.ndarray]]:
    """Arrays of buffers put together up to ``BATCH`` bytes of text."""
    held, size = [], 0
    for n, arrays in found:
        held.append(arrays)
        size += n
        if size >= BATCH:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _emitted(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_ROW)


def phrase_replies(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """(doc, repeats, mixed): triggers whose phrase stands earlier, and first ones of grams with several phrases."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parses = (Parse(b, length) for b in buffers(_texts(batches), length))
        for grams, phrases, docs, places in _batched((len(p.buffer.data), p.phrases()) for p in parses):
            order, _, first, later = _first_places([grams, phrases], docs, places)
            out = []
            gone = order[later]
            if len(gone):
                out += _dealt(REPEAT, (mix(docs[gone].view(np.uint64)) % np.uint64(buckets)).astype(np.int32), None, None, docs[gone], places[gone])
            one = order[first]  # of each gram and phrase
            g, p = grams[one], phrases[one]
            number, begins = groups(g)
            several = np.bincount(number, minlength=len(begins))[number] > 1 if len(g) else np.zeros(0, bool)
            bucket, low = (mix(g) % np.uint64(buckets)).astype(np.int32), (g >> np.uint64(32)).astype("<u4")
            alone = np.flatnonzero(~several)
            if len(alone):
                out += _dealt(GRAM, bucket[alone], low[alone], p[alone], docs[one[alone]], places[one[alone]])
            parted = np.flatnonzero(several)
            if len(parted):
                to = (mix(p[parted]) % np.uint64(buckets)).astype(np.int32)
                out += _dealt(PHRASE, to, p[parted], None, docs[one[parted]], places[one[parted]])
                told = begins[several[begins]]
                blank = np.zeros(len(told), np.int64)
                out += _dealt(SEVERAL, bucket[told], low[told], None, blank, blank)
            yield from _emitted(out)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, repeats, mixed = _gathered(batches), [], []
        if REPEAT in found:
            repeats.append((found[REPEAT][2], found[REPEAT][3]))
        if GRAM in found:
            grams, phrases, docs, places = found[GRAM]
            order, _, first, later = _first_places([grams, phrases], docs, places)
            repeats.append((docs[order[later]], places[order[later]]))
            kept = order[first]
            number, begins = groups(grams[kept])
            parted = np.bincount(number)[number] > 1
            if SEVERAL in found:
                parted |= np.isin(grams[kept], found[SEVERAL][0])
            mixed.append((docs[kept[parted]], places[kept[parted]]))
        if PHRASE in found:
            phrases, _, docs, places = found[PHRASE]
            order, _, first, later = _first_places([phrases], docs, places)
            repeats.append((docs[order[later]], places[order[later]]))
            mixed.append((docs[order[first]], places[order[first]]))
        reply = _replies(repeats, mixed)
        if reply is not None:
            yield reply

    dealt = rows.mapInArrow(scatter, _DEALT).repartitionById(buckets, "bucket")
    return dealt.mapInArrow(gather, _REPLY)


def string_replies(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """(doc, repeats, mixed): strings that stand earlier, among those of (doc, text, spans, mixed) that are still open."""

    def open_strings(parse: Parse) -> tuple[np.ndarray, ...]:
        buffer, marked = parse.buffer, []
        settled = np.zeros(len(buffer.data), bool)
        for begin, end, base, (spans, mixed) in zip(buffer.begin.tolist(), buffer.end.tolist(), buffer.base.tolist(), buffer.extra):
            places = _unpacked(mixed) - base + begin
            marked.append(places[(places >= begin) & (places < end)])
            for b, e in (_unpacked(spans).reshape(-1, 2) - base + begin).tolist():
                settled[max(begin, b) : max(begin, min(end, e + 1))] = True
        return parse.strings(np.concatenate(marked), settled)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parses = (Parse(b, length) for b in buffers(_texts(batches), length))
        for keys, others, docs, places in _batched((len(p.buffer.data), open_strings(p)) for p in parses):
            order, _, first, later = _first_places([keys], docs, places)
            out, gone, one = [], order[later], order[first]
            if len(gone):
                out += _dealt(REPEAT, (mix(docs[gone].view(np.uint64)) % np.uint64(buckets)).astype(np.int32), None, None, docs[gone], places[gone])
            if len(one):
                out += _dealt(STRING, (others[one] % np.uint64(buckets)).astype(np.int32), keys[one], None, docs[one], places[one])
            yield from _emitted(out)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, repeats = _gathered(batches), []
        if REPEAT in found:
            repeats.append((found[REPEAT][2], found[REPEAT][3]))
        if STRING in found:
            keys, _, docs, places = found[STRING]
            order, _, _, later = _first_places([keys], docs, places)
            repeats.append((docs[order[later]], places[order[later]]))
        reply = _replies(repeats, [])
        if reply is not None:
            yield reply

    dealt = rows.mapInArrow(scatter, _DEALT).repartitionById(buckets, "bucket")
    return dealt.mapInArrow(gather, _REPLY)


def _packed(values: np.ndarray) -> bytes:
    return _planes(np.diff(values.astype(np.int64), prepend=np.int64(0))) if len(values) else b""


def _unpacked(raw: bytes | None) -> np.ndarray:
    return np.cumsum(_from_planes(raw, "<i8")) if raw else np.zeros(0, np.int64)


def _spans(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Intervals with both ends included, by their begin, as disjoint ones that do not touch."""
    if not len(begins):
        return np.zeros((0, 2), np.int64)
    furthest = np.maximum.accumulate(ends)
    new = np.append(True, begins[1:] > furthest[:-1] + 1)
    at = np.flatnonzero(new)
    return np.stack((begins[at], furthest[np.append(at[1:], len(begins)) - 1]), axis=1)


def _merged(replies: DataFrame, before: int) -> DataFrame:
    """(doc, spans, mixed, n_mixed): starts of repeated strings as spans from ``before`` bytes before each place up to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, mixed, counts = [], [], []
            for repeats, open_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                places = np.sort(np.frombuffer(b"".join(repeats), "<i8"))
                spans.append(_packed(_spans(np.maximum(places - before, 0), places).ravel()))
                left = np.unique(np.frombuffer(b"".join(open_), "<i8"))
                mixed.append(_packed(left))
                counts.append(len(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.binary()), pa.array(mixed, pa.binary()), pa.array(counts, pa.int64())], names=["doc", "spans", "mixed", "n_mixed"]
            )

    listed = replies.groupBy("doc").agg(F.collect_list("repeats").alias("repeats"), F.collect_list("mixed").alias("mixed"))
    return listed.mapInArrow(run, "doc bigint, spans binary, mixed binary, n_mixed bigint")


def _joined(rows: DataFrame, found: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Texts with what was found of them, which is broadcast up to a measured size."""
    wanted = found.select("doc", *columns)
    total = wanted.agg(F.sum(sum((F.coalesce(F.length(c), F.lit(0)) for c in columns), F.lit(64)))).first()[0] or 0
    return rows.join(F.broadcast(wanted) if total <= BROADCAST_BYTES else wanted, "doc", how)


def _keyed(docs: DataFrame, scratch: Scratch, doc_id: str, text: str) -> DataFrame:
    """(doc, text, doc_id): ``doc`` is the id, or the row's rank where ids are null or not unique."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    told = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL")
    if not told.limit(1).count():
        return rows.select(F.col("doc_id").alias("doc"), "text", "doc_id")
    known = rows.withColumn("version", text_key(F.col("text")))
    each = ranked(known.select(F.lit("").alias("all"), "doc_id", "version").distinct(), ["all"], [F.asc_nulls_first("doc_id"), F.asc("version")], scratch)
    places = scratch.table(each.select(F.col("doc_id").alias("of"), F.col("version").alias("as"), F.col("position").alias("doc")), "places")
    match = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), F.col("version").cast("string"))
    own = places.withColumnsRenamed({"of": "doc_id", "as": "version"})
    return split_join(known, own, match).select("doc", "text", "doc_id")


def dedup_bytes(docs: DataFrame, scratch: Scratch, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row.

    Bytes covered by a string of ``length`` that also starts earlier go; ``spans`` are the maximal runs that
    go as (begin, end), the end not included, and ``kept`` is what stays.
    """
    if length < 2:
        raise ValueError("length is 2 at least")
    rows = _keyed(docs, scratch, doc_id, text)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least, reach = min(partitions(docs.sparkSession), 16), length - max(1, length // 2)
    buckets = max(least, 2 * total // (reach + 1) // BUCKET + 1)
    first = scratch.table(_merged(phrase_replies(rows.select("doc", "text"), length, buckets), reach), "phrases")
    # a string or so for every byte between two triggers
    strings = (first.agg(F.sum("n_mixed")).first()[0] or 0) * (reach + 1) // 2
    found = first.select("doc", "spans", F.lit(None).cast("binary").alias("more"))
    if strings:
        open_ = _joined(rows.select("doc", "text"), first.filter("n_mixed > 0"), ["spans", "mixed"], "inner")
        buckets = max(least, strings // BUCKET + 1)
        second = scratch.table(_merged(string_replies(open_, length, buckets), 0), "strings").select("doc", F.col("spans").alias("more"))
        found = scratch.table(first.select("doc", "spans").join(second, "doc", "left"), "found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 1):
            out: list[list] = [[], [], [], []]
            for value, *parts in zip(*(chunk.column(i).to_pylist() for i in (1, 2, 3))):
                raw = (value or "").encode()
                both = np.concatenate([_unpacked(p).reshape(-1, 2) for p in parts])
                both = both[np.argsort(both[:, 0], kind="stable")]
                both = np.minimum(both, len(raw) - length)  # the last string there is
                runs = _spans(both[:, 0], both[:, 1] + length - 1)
                ends = np.concatenate(([0], (runs + [0, 1]).ravel(), [len(raw)])).tolist()
                kept = b"".join([raw[b:e] for b, e in zip(ends[::2], ends[1::2])])
                for column, v in zip(out, (len(raw), len(raw) - len(kept), [{"begin": b, "end": e} for b, e in zip(ends[1:-1:2], ends[2:-1:2])], kept)):
                    column.append(v)
            types = [pa.int64(), pa.int64(), _RUNS, pa.binary()]
            yield pa.RecordBatch.from_arrays([chunk.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    flagged = _joined(rows, found, ["spans", "more"], "left").select("doc_id", "text", "spans", "more")
    return flagged.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")


_RUNS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
