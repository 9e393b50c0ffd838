"""Hierarchical packing of token ids into sequences of several context sizes.

A document's full windows of the longest tier stand alone; what is left of it goes to the shortest
tier that holds it. From the longest tier down, each window takes its tier's pieces, and its gap is
filled from the shorter tiers, largest fitting piece first, the last one cut to size. Windows
of one tier are then dealt by their attention cost into step groups whose tokens differ by one window at most. All of it
happens in the task that reads the documents, pool by pool, so nothing is shuffled and memory is
bounded by a pool (``POOL_TOKENS``) and the longest document. What one pool leaves over opens the
next; a task's last remainder is cut into powers of two, so no sequence carries padding.

Ids are taken as BIGINT. Null or empty text: the end id alone. A very long text is encoded whole and fills windows of its
own; it is in memory alone with its pool. Null ids and repeated rows: packed row by row like any other.
Empty table: no pieces. Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import chunks
from membertide.llm.tokens import default_tokenizer, encoder

TIERS = (2048, 1024, 512, 256)
POOL_TOKENS = 1 << 20
STEP_TOKENS = 1 << 15
END_ID = 1

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_id bigint"
)
#: A piece: length, document (its number in the task), begin in the document.
Piece = tuple[int, int, int]


class TierPacker:
    """Windows of one task: ``pack`` empties a pool, ``finish`` what the last pool left."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
            raise ValueError("tiers are powers of two, longest first")
        self.tiers = tiers
        self.pools: dict[int, list[Piece]] = {t: [] for t in tiers}

    def add(self, doc: int, n_tokens: int) -> list[tuple[int, list[Piece]]]:
        """Full windows of the longest tier; the rest is routed."""
        longest = self.tiers[0]
        full = n_tokens // longest
        windows = [(longest, [(longest, doc, i * longest)]) for i in range(full)]
        self._route((n_tokens - full * longest, doc, full * longest))
        return windows

    def _route(self, piece: Piece) -> None:
        if piece[0]:
            insort(self.pools[next(t for t in reversed(self.tiers) if t >= piece[0])], piece)

    def _take(self, gap: int, below: tuple[int, ...]) -> Piece | None:
        """The largest piece that fits from the shorter tiers, else the largest one cut to the gap."""
        for tier in below:
            pool = self.pools[tier]
            at = bisect_right(pool, (gap, float("inf")))
            if at:
                return pool.pop(at - 1)
        for tier in below:
            if self.pools[tier]:
                length, doc, begin = self.pools[tier].pop()
                self._route((length - gap, doc, begin + gap))
                return gap, doc, begin
        return None

    def pack(self) -> list[tuple[int, list[Piece]]]:
        windows = []
        for i, tier in enumerate(self.tiers):
            while sum_at_least(self.pools, self.tiers[i:], tier) and self.pools[tier]:
                window = [self.pools[tier].pop()]
                gap = tier - window[0][0]
                while gap:
                    piece = self._take(gap, self.tiers[i:])
                    window.append(piece)
                    gap -= piece[0]
                windows.append((tier, window))
        return windows

    def finish(self) -> list[tuple[int, list[Piece]]]:
        windows = self.pack()
        rest = [p for t in self.tiers for p in self.pools[t]]
        left, size = sum(p[0] for p in rest), self.tiers[0]
        while rest:
            while size > left:
                size //= 2
            window, gap = [], size
            while gap:
                length, doc, begin = rest.pop()
                if length > gap:
                    rest.append((length - gap, doc, begin + gap))
                    length = gap
                window.append((length, doc, begin))
                gap -= length
            windows.append((size, window))
            left -= size
        self.pools = {t: [] for t in self.tiers}
        return windows


def sum_at_least(pools: dict[int, list[Piece]], tiers: tuple[int, ...], wanted: int) -> bool:
    """Whether the pools of ``tiers`` hold ``wanted`` tokens together."""
    total = 0
    for tier in tiers:
        for piece in pools[tier]:
            total += piece[0]
            if total >= wanted:
                return True
    return False


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group per window: groups of a tier differ by one window at most; attention cost is dealt back and forth."""
    groups, first = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        cost = sorted((-sum(p[0] ** 2 for p in w), i) for i, (t, w) in enumerate(windows) if t == tier)
        count = -(-len(cost) * tier // step_tokens)
        for rank, (_, i) in enumerate(cost):
            lap, at = divmod(rank, count)
            groups[i] = first + (at if lap % 2 == 0 else count - 1 - at)
        first += count
    return groups


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents, with their ids (little-endian unsigned 32-bit), window and step."""
    path = tokenizer or default_tokenizer()
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "start", "length")]
        + [("ids", pa.binary())]
        + [(c, pa.int64()) for c in ("doc_tokens", "sequence_id", "offset")]
        + [("tier", pa.int32()), ("step_id", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        packer, known, pooled, done, sequence, step = TierPacker(tiers), {}, 0, [], 0, 0
        base = TaskContext.get().partitionId() << 36

        def rows(windows):
            nonlocal sequence, step
            groups = step_groups(windows, step_tokens)
            out = []
            for (tier, window), group in zip(windows, groups):
                offset = 0
                for length, doc, begin in window:
                    key, ids = known[doc]
                    out.append(
                        (key, begin, length, ids[4 * begin : 4 * (begin + length)], len(ids) // 4, base + sequence, offset, tier, base + step + group)
                    )
                    offset += length
                sequence += 1
                if len(out) >= 4096:
                    yield batch_of(out)
                    out = []
            step += max(groups, default=-1) + 1
            if out:
                yield batch_of(out)

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        number = 0
        for chunk in chunks(batches, 1):
            for key, ids in zip(chunk.column(0).to_pylist(), encode(chunk.column(1), end_id)):
                known[number] = key, ids
                done += packer.add(number, len(ids) // 4)
                pooled += len(ids) // 4
                number += 1
                if pooled >= POOL_TOKENS:
                    yield from rows(done + packer.pack())
                    left = {p[1] for pool in packer.pools.values() for p in pool}
                    known, pooled, done = {d: known[d] for d in left}, 0, []
        yield from rows(done + packer.finish())

    return docs.select(F.col(doc_id).cast("bigint"), F.col(text)).mapInArrow(run, SCHEMA)


def pieces_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
