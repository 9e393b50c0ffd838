"""Merkle manifest of a dataset whose parents keep SHA-256 states before each child's slot.

A node is the SHA-256, in lowercase hexadecimal, of its children's digests as text. A digest's text
is 64 bytes, one block of the hash, so the state of a parent before any of its children is a plain
256-bit value that is written next to the digests. A changed leaf is folded by resuming, level by
level, the state kept before its slot with the replacement and the siblings to its right;
siblings to its left are never read again.

Every group (a language, say) has a tree over its leaves in order; the groups' roots in order have one
above them. ``fanout`` consecutive nodes make a parent, the last one may have fewer, even one.
Trees are built by storeys: ``fanout ** height`` nodes are a block, which is one row of a written
table with its digests and states, and a block's top is a node of the next storey. Leaves get their
block from a rank that needs no window over a group, so a group of any size is spread over tasks and
a task holds one block. Paths come down the same storeys: a block hands each node its siblings and
states, so that a leaf's block has all it needs for proofs and folding in one place.

Leaf digests come from DataFrame functions. Null fields have a form of their own (``-``). Leaves with
a null id come first in their group, equal ids are ordered by digest; repeated rows are leaves of
their own. A null group is one of its own, before the others. A group of one leaf is that leaf's
digest. Empty table: no rows. Texts are hashed where they are read and go no further. Only the
columns named are read, so names in clash do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import BROADCAST_BYTES, Scratch
from membertide.llm.ranks import ranked
from membertide.llm.sha_states import INITIAL, absorbed, closed, hex_block, raw_bytes, words

FANOUT = 2
#: Levels of a block: 4,096 nodes at fanout 2.
HEIGHT = 12
_DIGEST = 32
_BLOCK = "key string, block bigint, total bigint, n int, ids array<bigint>, digests binary, states binary, replaced binary, top binary"
_PATH = "key string, block bigint, path binary"


def leaf(columns: list[str]) -> Column:
    """The digest of a row, as text: of each field its UTF-8 length, a colon and the value, or ``-``."""
    fields = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def _depth(total: int, fanout: int) -> int:
    """Levels above ``total`` nodes."""
    levels = 0
    while total > 1:
        total, levels = -(-total // fanout), levels + 1
    return levels


class Block:
    """The levels over some consecutive nodes, bottom first, with the states before all slots but the first."""

    def __init__(self, digests: list[np.ndarray], states: list[np.ndarray], fanout: int):
        self.digests, self.states, self.fanout = digests, states, fanout

    @classmethod
    def build(cls, nodes: np.ndarray, levels: int, fanout: int) -> Block:
        digests, states = [nodes], []
        for _ in range(levels):
            below = hex_block(digests[-1])
            count = below.shape[1]
            parents = -(-count // fanout)
            children = np.minimum(count - np.arange(parents) * fanout, fanout)
            state, kept = np.broadcast_to(INITIAL, (8, parents)), np.zeros((fanout - 1, 8, parents), np.uint32)
            for slot in range(min(fanout, count)):
                if slot:
                    kept[slot - 1] = state
                at = np.minimum(np.arange(parents) * fanout + slot, count - 1)
                state = np.where(children > slot, absorbed(state, below[:, at]), state)
            digests.append(closed(state, children))
            states.append(kept)
        return cls(digests, states, fanout)

    def packed(self) -> tuple[bytes, bytes]:
        return b"".join(map(raw_bytes, self.digests)), b"".join(s.astype("<u4").tobytes() for s in self.states)

    @classmethod
    def unpacked(cls, n: int, digests: bytes, states: bytes, fanout: int) -> Block:
        every, kept, at, done = words(digests), np.frombuffer(states, "<u4"), 0, 0
        levels, before = [], []
        while True:
            levels.append(every[:, at : at + n])
            at += n
            if at >= every.shape[1]:
                return cls(levels, before, fanout)
            n = -(-n // fanout)
            size = (fanout - 1) * 8 * n
            before.append(kept[done : done + size].reshape(fanout - 1, 8, n).astype(np.uint32))
            done += size

    def steps(self) -> Iterator[Step]:
        """What each of the nodes needs on every level, bottom first."""
        place = np.arange(self.digests[0].shape[1])
        for below, states in zip(self.digests, self.states):
            slot, parent = place % self.fanout, place // self.fanout
            count = np.minimum(below.shape[1] - parent * self.fanout, self.fanout)
            before = np.where(slot > 0, states[np.maximum(slot - 1, 0), :, parent].T, INITIAL)
            at = np.minimum(parent * self.fanout + np.arange(self.fanout)[:, None], below.shape[1] - 1)
            yield Step(slot, count, before, below[:, at])
            place = parent


@dataclass
class Step:
    """One level for some nodes: slot, number of siblings and itself, state before the slot, all the run's digests."""

    slot: np.ndarray
    count: np.ndarray
    before: np.ndarray  # 8 by nodes
    run: np.ndarray  # 8 by fanout by nodes

    def folded(self, digest: np.ndarray) -> np.ndarray:
        """The parents' digests with ``digest`` in the slots: the kept states go on from there."""
        state = absorbed(self.before, hex_block(digest))
        for other in range(1, int(self.count.max())):
            right = (other > self.slot) & (other < self.count)
            if right.any():
                state = np.where(right, absorbed(state, hex_block(self.run[:, other])), state)
        return closed(state, self.count)

    def siblings(self) -> tuple[np.ndarray, np.ndarray]:
        """All others of the run as (nodes, fanout, 32) bytes, and which of them there are."""
        raw = np.ascontiguousarray(self.run.transpose(2, 1, 0)).astype(">u4").view(np.uint8)
        other = np.arange(self.run.shape[1])
        return raw, (other != self.slot[:, None]) & (other < self.count[:, None])

    def packed(self) -> np.ndarray:
        """A row of bytes per node."""
        state = np.ascontiguousarray(self.before.T).astype(">u4").view(np.uint8)
        run = self.siblings()[0].reshape(len(self.slot), -1)
        return np.concatenate((np.stack((self.slot, self.count), axis=1).astype(np.uint8), state, run), axis=1)

    @classmethod
    def unpacked(cls, raw: bytes, fanout: int) -> Step:
        """The step of one node."""
        run = words(raw[2 + _DIGEST :]).reshape(8, fanout, 1)
        return cls(np.array([raw[0]]), np.array([raw[1]]), words(raw[2 : 2 + _DIGEST]), run)


def _steps(path: bytes, fanout: int) -> list[Step]:
    size = 2 + _DIGEST * (1 + fanout)
    return [Step.unpacked(path[i : i + size], fanout) for i in range(0, len(path), size)]


@dataclass(frozen=True)
class Manifest:
    """Storeys of the groups' trees and of the tree over their roots, as written tables of blocks."""

    groups: list[DataFrame]
    roots: DataFrame  # (group, digest, position) of the groups' roots
    crown: list[DataFrame]
    fanout: int
    size: int  # nodes of a block


def _storeys(nodes: DataFrame, fanout: int, height: int, scratch: Scratch) -> list[DataFrame]:
    """Blocks of every storey over ``nodes`` (key, position, total, id, digest, replaced)."""
    size, storeys = fanout**height, []

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        total, n = table.column("total")[0].as_py(), table.num_rows
        block = Block.build(words(b"".join(table.column("digest").to_pylist())), min(height, _depth(total, fanout)), fanout)
        digests, states = block.packed()
        row = {
            "key": table.column("key")[0].as_py(), "block": table.column("position")[0].as_py() // size, "total": total, "n": n,
            "ids": table.column("id").to_pylist(), "digests": digests, "states": states,
            "replaced": b"".join(table.column("replaced").to_pylist()), "top": raw_bytes(block.digests[-1]),
        }
        types = {"n": pa.int32(), "ids": pa.list_(pa.int64()), "block": pa.int64(), "total": pa.int64()}
        return pa.table({k: pa.array([v], types.get(k, pa.binary() if isinstance(v, bytes) else pa.string())) for k, v in row.items()})

    while True:
        grouped = nodes.withColumn("block", F.expr(f"position div {size}")).groupBy("key", "block")
        storeys.append(scratch.table(grouped.applyInArrow(build, _BLOCK), f"storey{len(storeys)}"))
        above = storeys[-1].filter(F.col("total") > size)
        if not above.limit(1).count():
            return storeys
        none = F.lit(b"")
        nodes = above.select("key", F.col("block").alias("position"), F.expr(f"total div {size} + int(total % {size} > 0)").alias("total"), F.lit(None).cast("bigint").alias("id"), F.col("top").alias("digest"), none.alias("replaced"))


def _tops(storeys: list[DataFrame], size: int) -> DataFrame:
    """(key, top): the root of each key's tree."""
    tops = [s.filter(F.col("total") <= size).select("key", "top") for s in storeys]
    out = tops[0]
    for further in tops[1:]:
        out = out.union(further)
    return out


def build(
    leaves: DataFrame, scratch: Scratch, group: str = "lang", doc_id: str = "doc_id", digest: str = "leaf", replaced: str | None = None,
    fanout: int = FANOUT, height: int = HEIGHT,
) -> Manifest:
    """The manifest of ``leaves``, a row each with its group, id and digest as text.

    ``replaced`` names the digest to fold with later, null where it is the same.
    """
    if not 2 <= fanout <= 64 or height < 1:
        raise ValueError("fanout is 2 to 64, height at least 1")
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null first
    other = F.col(replaced) if replaced else F.lit(None).cast("string")
    rows = leaves.select(key.alias("key"), F.col(doc_id).cast("bigint").alias("id"), F.unhex(digest).alias("digest"), F.unhex(F.coalesce(other, digest)).alias("replaced"))
    nodes = ranked(rows, ["key"], [F.asc_nulls_first("id"), F.asc("digest")], scratch)
    groups = _storeys(nodes, fanout, height, scratch)
    # ranked by key within the one group there is
    roots = _tops(groups, fanout**height).select(F.lit("").alias("key"), F.col("key").alias("group"), F.col("top").alias("digest"))
    roots = scratch.table(ranked(roots, ["key"], [F.asc("group")], scratch), "roots")
    crown = roots.select("key", "position", "total", F.lit(None).cast("bigint").alias("id"), "digest", F.lit(b"").alias("replaced"))
    return Manifest(groups, roots, _storeys(crown, fanout, height, scratch), fanout, fanout**height)


def _joined(blocks: DataFrame, paths: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks with their paths, which are broadcast as long as their measured size allows."""
    paths = scratch.table(paths, "paths")
    total = paths.agg(F.sum(F.length("path") + 64)).first()[0] or 0
    return blocks.join(F.broadcast(paths) if total <= BROADCAST_BYTES else paths, ["key", "block"])


def _descended(blocks: DataFrame, fanout: int, size: int) -> DataFrame:
    """(key, block, path) for each node of the blocks, which are blocks of the storey below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, number, n, digests, states, path = (batch.column(c)[i].as_py() for c in ("key", "block", "n", "digests", "states", "path"))
                head, above = path[: 2 * _DIGEST], path[2 * _DIGEST :]
                steps = [s.packed() for s in Block.unpacked(n, digests, states, fanout).steps()]
                own = np.concatenate([*steps, np.zeros((n, 0), np.uint8)], axis=1)
                paths = [head + row.tobytes() + above for row in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.string()), pa.array(range(number * size, number * size + n), pa.int64()), pa.array(paths, pa.binary())], names=["key", "block", "path"]
                )

    return blocks.select("key", "block", "n", "digests", "states", "path").mapInArrow(run, _PATH)


def _paths(manifest: Manifest, scratch: Scratch) -> DataFrame:
    """(key, block, path) of the lowest storey's blocks: the group's root, the root, and all steps above."""
    root = _tops(manifest.crown, manifest.size).select("key", F.lit(0).cast("bigint").alias("block"), F.concat("top", "top").alias("path"))
    for storey in reversed(manifest.crown):
        root = _descended(_joined(storey, root, scratch), manifest.fanout, manifest.size)
    # the nodes of the crown's lowest storey are the groups' roots, and each is the top of a group's last block
    ends = manifest.roots.select("position", F.col("group"), "digest").join(root.select(F.col("block").alias("position"), "path"), "position")
    ends = scratch.table(ends.select(F.col("group").alias("key"), F.concat("digest", F.expr(f"substring(path, {_DIGEST + 1})")).alias("path")), "ends")
    paths = None
    for storey in reversed(manifest.groups):
        alone = storey.filter(F.col("total") <= manifest.size).select("key", "block").join(ends, "key")
        paths = alone if paths is None else paths.union(alone)
        if storey is not manifest.groups[0]:
            paths = _descended(_joined(storey, paths, scratch), manifest.fanout, manifest.size)
    return paths


def fold(manifest: Manifest, scratch: Scratch) -> DataFrame:
    """Per leaf (id, key, leaf, subroot, root, proof, folded_root): digests as text.

    ``proof`` is the SHA-256 of the siblings on the way to the root, ``folded_root`` the root that
    comes from the replaced leaf and the kept states.
    """
    fanout, schema = manifest.fanout, "id bigint, key string, leaf string, subroot string, root string, proof string, folded_root string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("key", "n", "ids", "digests", "states", "replaced", "path")}
                n, path = row["n"], row["path"]
                block, above = Block.unpacked(n, row["digests"], row["states"], fanout), _steps(path[2 * _DIGEST :], fanout)
                digest, proofs = words(row["replaced"]), [hashlib.sha256() for _ in range(n)]
                for step in block.steps():
                    digest = step.folded(digest)
                    raw, there = step.siblings()
                    for proof, others, given in zip(proofs, raw, there):
                        proof.update(others[given].tobytes().hex().encode())
                shared = []
                for step in above:
                    digest = step.folded(digest)
                    raw, there = step.siblings()
                    shared.append(raw[0][there[0]].tobytes().hex().encode())
                for proof in proofs:
                    proof.update(b"".join(shared))
                folded, own = raw_bytes(digest).hex(), row["digests"][: n * _DIGEST].hex()
                text = lambda whole: [whole[j : j + 2 * _DIGEST] for j in range(0, len(whole), 2 * _DIGEST)]
                columns = [row["ids"], [row["key"]] * n, text(own), [path[:_DIGEST].hex()] * n, [path[_DIGEST : 2 * _DIGEST].hex()] * n]
                columns += [[p.hexdigest() for p in proofs], text(folded)]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])], schema=_FOLDED)

    blocks = _joined(manifest.groups[0], _paths(manifest, scratch), scratch)
    return blocks.select("key", "n", "ids", "digests", "states", "replaced", "path").mapInArrow(run, schema)


_FOLDED = pa.schema([("id", pa.int64()), *((c, pa.string()) for c in ("key", "leaf", "subroot", "root", "proof", "folded_root"))])
