"""Numbers by the million dealt to buckets as packed binary columns, a row per bucket and batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from membertide.llm.common import flat_binary, mix

#: Keys a bucket is to hold at most on average; the buckets follow the measured number of keys.
BUCKET_KEYS = 1 << 21


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``capacity`` words."""

    capacity = 100_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.capacity:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


_hashes = WordHashes()


def word_hashes(words: list[list[bytes]]) -> np.ndarray:
    """The hashes of all words of all texts in one array."""
    total = sum(map(len, words))
    return np.fromiter((_hashes[w] for ws in words for w in ws), np.uint64, total)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order."""
    return mix(mix(left + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(3) + right)


def windows(codes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` codes, by doubling; shorter than ``codes`` by length - 1."""
    if len(codes) < length:
        return codes[:0]
    width, found = 1, mix(codes ^ np.uint64(0xD1B54A32D192ED03))
    while 2 * width <= length:
        found = pair(found[:-width], found[width:])
        width *= 2
    return pair(found[: len(found) - (length - width)], found[length - width :]) if width < length else found


def bucketed(keys: np.ndarray, buckets: int, columns: dict[str, np.ndarray], kind: int = 0) -> pa.RecordBatch:
    """A row per bucket that has keys, with the columns' values packed."""
    bucket = (mix(keys) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    numbers, counts = np.unique(bucket, return_counts=True)
    packed = [flat_binary(values[order], counts) for values in columns.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers), pa.array(np.full(len(numbers), kind, np.int32)), *packed], names=["bucket", "kind", *columns]
    )


def gathered(batches: Iterator[pa.RecordBatch], kinds: dict[str, np.dtype]) -> dict[int, list[np.ndarray]]:
    """All packed values of a partition by kind: one array per column."""
    parts: dict[int, list[list[bytes]]] = {}
    for batch in batches:
        for kind, *values in zip(batch.column("kind").to_pylist(), *(batch.column(c).to_pylist() for c in kinds)):
            own = parts.setdefault(kind, [[] for _ in kinds])
            for part, value in zip(own, values):
                part.append(value)
    return {k: [np.frombuffer(b"".join(p), t) for p, t in zip(own, kinds.values())] for k, own in parts.items()}


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For keys in order: the number of each one's group, and where each group begins."""
    new = np.empty(len(keys), bool)
    new[:1] = True
    new[1:] = keys[1:] != keys[:-1]
    return np.cumsum(new) - 1, np.flatnonzero(new)
