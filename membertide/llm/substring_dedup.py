"""Exact substring dedup by level-wise doubling of repeated windows.

Level one looks at windows of about half the target length, level two at those of the target
length around the ones that were repeated. From level one only the windows with the smallest hash
of their neighbourhood are exchanged: every target window holds one, chosen by its words alone, so equal
target windows choose alike and none is lost. Longer targets take further levels, each tried only where the last
one's windows were repeated. The target is one length: repeats are not followed beyond it.

Words of a window that also starts in a document with a smaller id are removed, judged on the
input. Copies of a whole text are told by the text's hash first: all their words go, if
there are enough for a window, and only the first copy takes part. Within a map batch equal windows are settled
before the exchange, so a hot window costs a row per batch.

Ids are taken as BIGINT. Words are ``[^\\x20\\x09-\\x0D]+``. Null or empty text: no words. A very long text is a chunk of its own. A null id is smaller and larger than
none: its words stay and remove nothing. Rows that share an id do not remove each other's words.
Empty table: no rows. Only the id and the text are read; windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import BROADCAST_BYTES, Scratch, chunks, partitions, small, split_join, text_key
from membertide.llm.exchange import BUCKET_KEYS, bucketed, gathered, groups, windows, word_hashes

WINDOW = 13
_COLUMNS = {"keys": np.dtype("<u8"), "docs": np.dtype("<i8"), "places": np.dtype("<u4")}
_DEALT = "bucket int, kind int, keys binary, docs binary, places binary"
_REPLY = "doc bigint, places binary"


def levels(window: int, shortest: int = 7) -> list[int]:
    """Lengths from about ``shortest`` up to ``window``, each at most twice the one before."""
    lengths = [window]
    while lengths[0] > shortest:
        lengths.insert(0, -(-lengths[0] // 2))
    return lengths


def slid(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values, by doubling."""
    done, out = 1, values
    while 2 * done <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    return pick(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


def chosen(values: np.ndarray, width: int) -> np.ndarray:
    """Places that have the smallest value of some run of ``width``; every run holds one."""
    if width == 1:
        return np.arange(len(values))
    pad = np.zeros(width - 1, np.uint64)
    least = slid(values, width, np.minimum)
    return np.flatnonzero(slid(np.concatenate((pad, least, pad)), width, np.maximum) == values)


def surviving(values: np.ndarray, width: int, flagged: np.ndarray) -> np.ndarray:
    """Runs of ``width`` whose smallest value is at a flagged place, by where they begin."""
    marked = np.full(len(values), np.iinfo(np.uint64).max)
    marked[flagged] = values[flagged]
    return np.flatnonzero(slid(marked, width, np.minimum) == slid(values, width, np.minimum))


def settle(keys: np.ndarray, docs: np.ndarray, places: np.ndarray, later: bool):
    """Among rows of one batch or bucket: which are answered, and which stand for their key.

    Answered are rows whose key more than one document has; with ``later`` all but the smallest's.
    """
    order = np.lexsort((docs, keys))
    keys, docs, places = keys[order], docs[order], places[order]
    group, begins = groups(keys)
    smallest = docs[begins][group] if len(keys) else docs
    first = docs == smallest
    if later:
        answered = ~first
    else:
        largest = docs[np.append(begins[1:], len(keys)) - 1][group] if len(keys) else docs
        answered = smallest != largest
    return keys, docs, places, answered, first


def _by_document(docs: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((places, docs))
    docs, places = docs[order], places[order]
    _, begins = groups(docs)
    counts = np.diff(np.append(begins, len(docs)))
    raw, ends = places.astype("<u4").tobytes(), np.cumsum(counts) * 4
    parts = [raw[e - 4 * c : e] for e, c in zip(ends.tolist(), counts.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(docs[begins], pa.int64()), pa.array(parts, pa.binary())], names=["doc", "places"])


def exchange(rows: DataFrame, emit, buckets: int, later: bool) -> DataFrame:
    """(doc, places): what ``emit`` finds in the rows' batches, answered across all documents."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, docs, places in emit(batches):
            keys, docs, places, answered, first = settle(keys, docs, places, later)
            if first.any():
                yield bucketed(keys[first], buckets, {"keys": keys[first], "docs": docs[first], "places": places[first]})
            if answered.any():
                known = docs[answered]
                blank = np.zeros(len(known), np.uint64)
                yield bucketed(known.view(np.uint64), buckets, {"keys": blank, "docs": known, "places": places[answered]}, kind=1)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = gathered(batches, _COLUMNS)
        docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        if 0 in found:
            _, d, p, answered, _ = settle(*found[0], later)
            docs.append(d[answered])
            places.append(p[answered])
        if 1 in found:
            docs.append(found[1][1])
            places.append(found[1][2])
        if sum(map(len, docs)):
            yield _by_document(np.concatenate(docs), np.concatenate(places))

    dealt = rows.mapInArrow(scatter, _DEALT).repartitionById(buckets, "bucket")
    return dealt.drop("bucket").mapInArrow(gather, _REPLY)


def _merged(answers: DataFrame, spans: bool) -> DataFrame:
    """(doc, places): all of a document's places, sorted and compressed; as spans (begin, end) if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column(1).to_pylist():
                places = np.unique(np.frombuffer(b"".join(parts), "<u4"))
                if spans:
                    new = np.flatnonzero(np.diff(places) > 1)
                    places = np.stack((places[np.append(0, new + 1)], places[np.append(new, len(places) - 1)]), axis=1).ravel()
                out.append(zlib.compress(np.diff(places, prepend=places.dtype.type(0)).astype("<u4").tobytes(), 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc", "places"])

    return answers.groupBy("doc").agg(F.collect_list("places").alias("places")).mapInArrow(run, _REPLY)


def _unpacked(raw: bytes | None) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), "<u4"), dtype=np.int64) if raw else np.zeros(0, np.int64)


def _emitter(lengths: list[int], level: int):
    """What a level exchanges of each batch of (doc, text[, places of the level before])."""
    window, length = lengths[-1], lengths[level]

    def emit(batches: Iterator[pa.RecordBatch]):
        for chunk in chunks(batches, 1):
            words = [(t or "").encode().split() for t in chunk.column(1).to_pylist()]
            before = chunk.column(2).to_pylist() if level else [None] * len(words)
            codes, begin = word_hashes(words), 0
            keys, docs, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for doc, own, flagged in zip(chunk.column(0).to_pylist(), words, before):
                text, begin = codes[begin : begin + len(own)], begin + len(own)
                if len(own) < window:
                    continue
                values = windows(text, length)
                at = chosen(values, window - length + 1)
                if level:
                    shorter = windows(text, lengths[level - 1])
                    known = _unpacked(flagged)
                    runs = surviving(shorter, window - lengths[level - 1] + 1, known[known < len(shorter)])
                    inside = np.zeros(len(values) + 1, np.int64)
                    np.add.at(inside, runs, 1)
                    np.add.at(inside, np.minimum(runs + window - length + 1, len(values)), -1)
                    at = at[np.cumsum(inside[:-1])[at] > 0]
                keys.append(values[at])
                docs.append(np.full(len(at), doc, np.int64))
                places.append(at)
            yield np.concatenate(keys), np.concatenate(docs), np.concatenate(places).astype("<u4")

    return emit


def _guarded(table: DataFrame, size) -> DataFrame:
    total = table.agg(F.sum(size + 64)).first()[0] or 0
    return F.broadcast(table) if total <= BROADCAST_BYTES else table


def dedup_substrings(docs: DataFrame, scratch: Scratch, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: the words that stay, joined by one space."""
    lengths = levels(window)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"), text_key(F.col(text)).alias("version"))
    whole = scratch.table(
        rows.filter("doc IS NOT NULL").select("doc", "version", F.xxhash64(F.lit(1), "text").alias("check"), F.octet_length("text").alias("size")), "whole"
    )
    lowest = whole.groupBy("version", "check").agg(F.min("doc").alias("lowest"), F.count("*").alias("n")).filter("n > 1")
    copies = scratch.table(split_join(whole, lowest, F.concat(F.hex("version"), F.lit("-"), F.hex("check"))).filter("doc > lowest").groupBy("doc").agg(F.max("version").alias("copy")), "copies")
    apart = rows.filter("doc IS NOT NULL").join(small(copies, 24), "doc", "left").filter("NOT copy <=> version").select("doc", "text")
    # about a word in four bytes; two places in every run and one are chosen
    keys = (whole.agg(F.sum("size")).first()[0] or 0) // (4 * (window - lengths[0] + 2) // 2)
    flagged = None
    for level, length in enumerate(lengths):
        last = level == len(lengths) - 1
        candidates = apart if flagged is None else apart.join(_guarded(flagged, F.length("places")), "doc")
        buckets = max(min(partitions(docs.sparkSession), 16), int(keys // BUCKET_KEYS) + 1)
        answers = exchange(candidates, _emitter(lengths, level), buckets, later=last)
        flagged = scratch.table(_merged(answers, spans=last), f"level{length}")
        keys = 4 * (flagged.agg(F.sum(F.length("places"))).first()[0] or 0)
        if not keys:
            break
    removal = flagged if keys and last else flagged.filter("false")
    removal = scratch.table(removal.join(copies, "doc", "full"), "removal")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 1):
            counts, gone, kept = [], [], []
            for value, raw, copy in zip(*(chunk.column(i).to_pylist() for i in (1, 2, 3))):
                words = (value or "").encode().split()
                stay = np.ones(len(words), bool)
                for begin, end in _unpacked(raw).reshape(-1, 2).tolist():
                    stay[begin : end + window] = False
                if copy and len(words) >= window:
                    stay[:] = False
                left = words if stay.all() else [words[i] for i in np.flatnonzero(stay)]
                counts.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    joined = rows.join(_guarded(removal, F.coalesce(F.length("places"), F.lit(0))), "doc", "left")
    flags = joined.select("doc", "text", "places", F.col("copy").eqNullSafe(F.col("version")).alias("copy"))
    return flags.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
