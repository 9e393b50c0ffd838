"""Prefix trie of conversations: a splitter skeleton over sorted shards.

A conversation's path is the hashes of its turns in order, eight bytes each, so that paths sort as
bytes and a prefix of turns is a prefix of bytes. Paths are dealt to shards by splitters and sorted.
A node whose subtree lies on both sides of a splitter is a prefix of that splitter; these few nodes, the
skeleton, are broadcast with the splitters. Each shard goes through its paths in order with a
stack and finishes every other node by itself. Of skeleton nodes it gives partial aggregates,
which are added up across shards and then from the skeleton's ends to its root.

Splitters come from a sample of the paths (``SAMPLE`` a shard) and are cut behind the first turn that
tells them from the sampled path before. They steer the sizes of shards only; every path is in
the trie. Splitters are thinned out until the skeleton has at most ``SKELETON_BYTES``.

Equal paths are combined before they are dealt: one row for the members of 65,536 consecutive ids.
So a conversation or a first turn that a third of all share puts no load on one task beyond
that: a shared turn is a skeleton node, and the members of one path are hashed in order, row by row.

Rows without a conversation id belong to none. Null role or text is empty. Turns go by number, null
first, equal ones by their hash. Repeated turns are turns of their own. Turns are compared by a
64-bit hash of role and text, so texts of any length move once, as eight bytes. A conversation is one row
of such hashes. Empty table: no nodes. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import Scratch, flat_binary, partitions, small

_TURN = 8  # bytes of a path per turn
SAMPLE = 32
#: Turns of a sampled path that are looked at.
SAMPLE_TURNS = 512
SKELETON_BYTES = 8 << 20
#: Rows of a batch of finished nodes.
BATCH = 20_000

NODE = (
    "sid bigint, parent_sid bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved bigint, last bigint, ends string"
)
_ARROW = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in NODE.split(", ")])


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order as (hash, code points of the text)."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    order = [F.col(turn).isNotNull().alias("numbered"), F.col(turn).alias("number"), F.xxhash64(*said).alias("hash")]
    one = F.struct(*order, F.length(said[1]).cast("int").alias("size"))
    rows = turns.filter(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("bigint").alias("conv_id"), one.alias("one"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("ones"))
    return grouped.select("conv_id", F.transform("ones", lambda t: F.struct(t["hash"].alias("hash"), t["size"].alias("size"))).alias("turns"))


def with_heads(whole: DataFrame, base: Column, length: Column, longest: int) -> DataFrame:
    """``whole`` rebuilt: the first ``length`` (at most ``longest``) turns of conversation ``base`` in place of its own.

    ``base`` and ``length`` are expressions of conv_id; of the bases only the heads are joined.
    """
    bases = whole.select(base.alias("base")).distinct()
    heads = whole.join(bases, F.col("conv_id") == F.col("base")).select("base", F.slice("turns", 1, longest).alias("head"))
    asked = whole.withColumns({"__base": base, "__length": length.cast("int")})
    joined = asked.join(heads, F.col("__base") == F.col("base"), "left")
    head = F.slice(F.coalesce("head", F.expr("slice(turns, 1, 0)")), F.lit(1), F.col("__length"))
    rest = F.slice("turns", F.col("__length") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def paths(whole: DataFrame) -> DataFrame:
    """(path, sizes, range, members): equal paths combined, with the ids of each range of 65,536."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.diff(batch.column(i).offsets.to_numpy()) for i in (1, 2)]
            hashes, sizes = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2))
            made = [flat_binary(hashes.astype(">i8"), counts[0]), flat_binary(sizes.astype("<u4"), counts[1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["conv_id", "path", "sizes"])

    flat = whole.select("conv_id", F.col("turns.hash").alias("hashes"), F.col("turns.size").alias("lengths"))
    packed = flat.mapInArrow(run, "conv_id bigint, path binary, sizes binary")
    grouped = packed.groupBy("path", "sizes", F.shiftright("conv_id", 16).alias("range"))
    return grouped.agg(F.array_sort(F.collect_list("conv_id")).alias("members"))


def _common(left: bytes, right: bytes) -> int:
    """Turns that both paths begin with."""
    most = min(len(left), len(right)) // _TURN
    if left[: most * _TURN] == right[: most * _TURN]:
        return most
    low, high = 0, most
    while low < high - 1:
        middle = (low + high) // 2
        low, high = (middle, high) if left[: middle * _TURN] == right[: middle * _TURN] else (low, middle)
    return low


@dataclass
class Skeleton:
    """Splitters, and a number for each of their prefixes; the empty one, the root, has number 0."""

    splitters: list[bytes]
    numbers: dict[bytes, int]

    @classmethod
    def over(cls, sampled: list[bytes], shards: int) -> Skeleton:
        ordered = sorted(set(sampled))
        while True:
            picked = [ordered[i * len(ordered) // shards] for i in range(1, shards)] if ordered else []
            cut = []
            for path in sorted(set(picked)):
                before = ordered[max(0, ordered.index(path) - 1)]
                cut.append(path[: (_common(before, path) + 1) * _TURN])
            splitters = sorted({c for c in cut if c})
            if sum(map(len, splitters)) <= SKELETON_BYTES or shards <= 1:
                break
            shards = (shards + 1) // 2
        prefixes = {b"", *(s[:end] for s in splitters for end in range(_TURN, len(s) + 1, _TURN))}
        return cls(splitters, {p: i for i, p in enumerate(sorted(prefixes))})

    def shard(self, path: bytes) -> int:
        return bisect_right(self.splitters, path)

    def parents(self) -> list[int | None]:
        return [self.numbers[p[:-_TURN]] if p else None for p in sorted(self.numbers)]


def skeleton_of(gathered: DataFrame) -> Skeleton:
    spark = gathered.sparkSession
    shards = partitions(spark)
    rows = gathered.count()
    # a sample by the path's hash, some rows a shard; it decides sizes of shards, not what is counted
    share = max(1, rows // (SAMPLE * shards))
    head = F.expr(f"substring(path, 1, {SAMPLE_TURNS * _TURN})").alias("head")
    found = gathered.filter(F.pmod(F.xxhash64("path", F.lit(1)), F.lit(share)) == 0).select(head).distinct()
    return Skeleton.over([bytes(r.head) for r in found.limit(4 * SAMPLE * shards).collect()], shards)


@dataclass
class Open:
    """A node on the stack."""

    last: int  # code points of its last text
    sid: int | None
    low: int | None = None
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None
    #: Rows of finished children, which lack their parent's smallest member.
    waiting: list[list] = field(default_factory=list)


class Shard:
    """Nodes of one shard's paths, given in order; ``done`` has the rows that are finished."""

    def __init__(self, numbers: dict[bytes, int]):
        self.numbers, self.done = numbers, []
        self.path = b""
        self.stack = [Open(0, 0)]
        self.hash = None

    def add(self, path: bytes, sizes: np.ndarray, members: list[int]) -> None:
        """Some members of a path; those of one path come in order, one call after the other."""
        if path != self.path or self.hash is None:
            self._settle()
            shared = _common(self.path, path)
            while len(self.stack) > shared + 1:
                self._pop()
            for depth in range(shared + 1, len(path) // _TURN + 1):
                above = self.stack[-1].sid
                sid = None if above is None else self.numbers.get(path[: depth * _TURN])
                self.stack.append(Open(int(sizes[depth - 1]), sid))
            self.path, self.hash = path, hashlib.sha256()
            self.hash.update(",".join(map(str, members)).encode())
        else:
            self.hash.update(("," + ",".join(map(str, members))).encode())
        top = self.stack[-1]
        top.n += len(members)
        top.low = members[0] if top.low is None else min(top.low, members[0])

    def _settle(self) -> None:
        if self.hash is not None:
            self.stack[-1].ends, self.hash = self.hash.hexdigest(), None

    def _pop(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        parent = self.stack[-1] if self.stack else None
        if parent is not None:
            parent.n += node.n
            parent.low = node.low if parent.low is None else min(parent.low, node.low)
        if node.sid is not None:  # partial: what lies below in this shard but outside the skeleton
            self.done.append([node.sid, None, node.low, depth, None, node.n, node.children, node.leaves, node.saved, node.last, node.ends])
            return
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.last
        for row in node.waiting:
            row[4] = node.low
        self.done += node.waiting
        row = [None, None, node.low, depth, None, node.n, node.children, node.leaves, node.saved, node.last, node.ends]
        parent.children += 1
        parent.leaves += node.leaves
        parent.saved += node.saved
        if parent.sid is None:
            parent.waiting.append(row)
        else:
            row[1] = parent.sid
            self.done.append(row)

    def finish(self) -> None:
        self._settle()
        while self.stack:
            self._pop()


def shard_nodes(gathered: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, and partial ones (with a sid) of the skeleton, of every shard."""
    shared = gathered.sparkSession.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.shard
        for batch in batches:
            found = pa.array([place(p) for p in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([found, *batch.columns], names=["shard", *batch.schema.names])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, None
        for batch in batches:
            for own, path, sizes, members in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if shard is None or own != number:
                    if shard is not None:
                        shard.finish()
                        yield rows(shard.done)
                    shard, number = Shard(shared.value.numbers), own
                shard.add(path, np.frombuffer(sizes, "<u4"), members)
                if len(shard.done) >= BATCH:
                    out, shard.done = shard.done, []
                    yield rows(out)
        if shard is not None:
            shard.finish()
            yield rows(shard.done)

    def rows(done: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _ARROW)], schema=_ARROW)

    columns = ["path", "sizes", "range", "members"]
    dealt = gathered.select(*columns).mapInArrow(deal, "shard int, path binary, sizes binary, range bigint, members array<bigint>")
    placed = dealt.repartitionById(len(skeleton.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "range")
    return placed.mapInArrow(build, NODE)


def _reduced(partial: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """The skeleton's nodes: sums over shards, then from its ends to the root. At most SKELETON_BYTES / 8 nodes."""
    sums = partial.groupBy("sid").agg(
        F.min("conv_id").alias("low"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("last").alias("last"), F.max("ends").alias("ends"),
    )
    found = {r.sid: r.asDict() for r in sums.collect()}
    parents = skeleton.parents()
    for sid in sorted(found, reverse=True):  # a prefix sorts before what it begins
        node = found[sid]
        node["leaves"] = node["leaves"] or 1
        node["saved"] += (node["n"] - 1) * node["last"]
        above = found.get(parents[sid])
        if above:
            above["children"] += 1
            above["leaves"] += node["leaves"]
            above["saved"] += node["saved"]
    low = lambda sid: found[sid]["low"] if sid is not None else None
    return [(sid, r["low"], r["depth"], low(parents[sid]), r["n"], r["children"], r["leaves"], r["saved"], r["ends"]) for sid, r in found.items()]


def trie(whole: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per node of the trie over (conv_id, turns).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved (members beyond
    the first times code points of the last text, over the subtree), ends (SHA-256 of the
    comma-joined ids that end there; of nothing if none does).
    """
    gathered = scratch.table(paths(whole), "paths")
    skeleton = skeleton_of(gathered)
    nodes = scratch.table(shard_nodes(gathered, skeleton), "nodes")
    reduced = _reduced(nodes.filter("sid IS NOT NULL"), skeleton)
    schema = "sid bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string"
    upper = scratch.table(whole.sparkSession.createDataFrame(reduced, schema).coalesce(1), "skeleton")
    above = upper.select(F.col("sid").alias("parent_sid"), F.col("conv_id").alias("above"))
    local = nodes.filter("sid IS NULL").join(small(above, 16), "parent_sid", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    ends = F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends")
    done = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*columns, ends)
    return done.union(upper.select(*columns, ends))
