"""Token counts that follow edits, from a segment tree of pre-tokens per document.

A leaf holds ``LEAF_WORDS`` words with the white space after them; every node has the bytes and the
tokens below it. An edit is located by descending on the byte sums. Its region, widened to the white
space on both sides (and into the neighbouring leaf where it touches the edge), is encoded before and
after; the difference goes into one leaf and the sums above it. All else keeps its counts.

``build`` gives the trees as two binary columns that can be stored with the text; ``update`` takes
them, with the edits of each document, to the new text, tree and counts. Edits are (begin, end, text)
in characters of the text as it was; they are taken in order, and one that overlaps an earlier one or lies
outside the text is skipped and counted. Rows without edits (null or empty list) stay as they are.

Null or empty text: no tokens; edits to a null text are skipped. Repeated rows are edited each by itself. Empty table:
no rows. A text of any length is a tree of its own, one in memory at a time with its chunk. Null ids
and other columns pass through; names in clash with what is added are refused, and ``prefix`` gives others. No
shuffle but the join of ``with_edits``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import chunks, extended
from membertide.llm.tokens import default_tokenizer, encoder

LEAF_WORDS = 16
EDITS = "array<struct<begin:int,end:int,text:string>>"
_EDITS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
_SPACE = np.zeros(256, bool)
_SPACE[list(b"\t\n\x0b\x0c\r ")] = True

Edit = tuple[int, int, bytes]


def heap(leaves: np.ndarray) -> np.ndarray:
    """A tree of sums: node i over nodes 2i and 2i + 1, the leaves in the second half."""
    size = 1
    while size < len(leaves):
        size *= 2
    tree = np.zeros(2 * size, np.int64)
    tree[size : size + len(leaves)] = leaves
    while size > 1:
        tree[size // 2 : size] = tree[size : 2 * size : 2] + tree[size + 1 : 2 * size : 2]
        size //= 2
    return tree


class TokenTree:
    """One document: its bytes by leaf, and the sums of bytes and tokens."""

    def __init__(self, raw: bytes, sizes: np.ndarray, tokens: np.ndarray, count):
        self.sizes, self.tokens, self.count = sizes, tokens, count
        self.half = len(sizes) // 2
        ends = np.cumsum(sizes[self.half :]).tolist()
        self.leaves = [raw[b:e] for b, e in zip([0, *ends], ends)]
        self.encoded = 0

    @staticmethod
    def shape(raw: bytes, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte and token trees of a text whose words have so many tokens."""
        space = _SPACE[np.frombuffer(raw, np.uint8)]
        starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))[::LEAF_WORDS]
        edges = np.concatenate(([0], starts[1:], [len(raw)])).astype(np.int64)
        tokens = np.add.reduceat(words, np.arange(0, len(words), LEAF_WORDS)) if len(words) else np.zeros(1, np.int64)
        return heap(np.diff(edges)), heap(tokens)

    def locate(self, place: int) -> tuple[int, int]:
        """The leaf with the byte at ``place``, and the place in it; the end belongs to the last leaf."""
        node, place = 1, min(place, int(self.sizes[1]))
        while node < self.half:
            node *= 2
            # the last byte's right edge stays on the left if nothing is on the right
            if place >= self.sizes[node] and self.sizes[node + 1]:
                place -= int(self.sizes[node])
                node += 1
        return node - self.half, place

    def _set(self, leaf: int, raw: bytes, tokens: int) -> None:
        """Replace a leaf's bytes, add to its tokens, and renew the sums above it."""
        added = len(raw) - len(self.leaves[leaf])
        self.leaves[leaf] = raw
        node = leaf + self.half
        while node:
            self.sizes[node] += added
            self.tokens[node] += tokens
            node //= 2

    def edit(self, begin: int, end: int, new: bytes) -> None:
        """Put ``new`` in place of the bytes from ``begin`` to ``end``."""
        first, at = self.locate(begin)
        last, _ = self.locate(max(begin, end - 1))
        old = b"".join(self.leaves[first : last + 1])
        left, right = at, at + end - begin
        while True:  # widen to white space, or the text's edge
            while left and not _SPACE[old[left - 1]]:
                left -= 1
            if left or not first:
                break
            first -= 1
            left, right, at = (n + len(self.leaves[first]) for n in (left, right, at))
            old = self.leaves[first] + old
        while True:
            while right < len(old) and not _SPACE[old[right]]:
                right += 1
            if right < len(old) or last + 1 >= len(self.leaves):
                break
            last += 1
            old += self.leaves[last]
        changed = old[left:at] + new + old[at + end - begin : right]
        before, after = self.count(old[left:right]), self.count(changed)
        self.encoded += len(old[left:right].split()) + len(changed.split())
        kept = sum(int(self.tokens[self.half + i]) for i in range(first + 1, last + 1))
        for leaf in range(last, first, -1):
            self._set(leaf, b"", -int(self.tokens[self.half + leaf]))
        self._set(first, old[:left] + changed + old[right:], kept + after - before)

    def text(self) -> bytes:
        return b"".join(self.leaves)


Batches = Iterator[pa.RecordBatch]
_TREES = {"size_tree": "binary", "token_tree": "binary", "n_tokens": "bigint"}
_TOLD = ("n_tokens_before", "n_edits", "n_skipped", "n_encoded")


def _building(path: str, columns: list[str], text: str, prefix: str) -> Callable[[Batches], Batches]:
    at, names = columns.index(text), [*columns, *(prefix + c for c in _TREES)]

    def run(batches: Batches) -> Batches:
        counts = encoder(path).counts
        for chunk in chunks(batches, at):
            raws = [(t or "").encode() for t in chunk.column(at).to_pylist()]
            trees = [TokenTree.shape(raw, words) for raw, words in zip(raws, counts(raws))]
            made = [pa.array([t[i].tobytes() for t in trees], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*chunk.columns, *made, pa.array([int(t[1][1]) for t in trees], pa.int64())], names=names)

    return run


def _refuse(columns: list[str], added, prefix: str) -> None:
    names = {c.lower() for c in columns}
    if taken := [prefix + c for c in added if (prefix + c).lower() in names]:
        raise ValueError(f"choose another prefix: {taken} are columns of the input")


def build(docs: DataFrame, tokenizer: str | None = None, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``size_tree`` and ``token_tree`` (little-endian 64-bit sums) and ``n_tokens``."""
    _refuse(docs.columns, _TREES, prefix)
    run = _building(tokenizer or default_tokenizer(), docs.columns, text, prefix)
    return docs.mapInArrow(run, extended(docs.schema, **{prefix + c: t for c, t in _TREES.items()}))


def with_edits(docs: DataFrame, edits: DataFrame, doc_id: str = "doc_id", name: str = "edits") -> DataFrame:
    """``docs`` with the edits (doc_id, begin, end, text) of each document as one list."""
    one = F.struct(F.col("begin").cast("int").alias("begin"), F.col("end").cast("int").alias("end"), F.col("text").alias("text"))
    lists = edits.groupBy(F.col(doc_id).alias("__edits_of")).agg(F.array_sort(F.collect_list(one)).alias(name))
    return docs.join(lists, F.col(f"`{doc_id}`") == F.col("__edits_of"), "left").drop("__edits_of")


def in_bytes(text: str, edits: list[dict] | None) -> tuple[list[Edit], int]:
    """The edits that hold, in bytes of the text, and how many are skipped."""
    good, done = [], 0
    for e in sorted(edits or [], key=lambda e: (e["begin"] is None or e["end"] is None, e["begin"] or 0, e["end"] or 0)):
        if e["begin"] is not None and e["end"] is not None and done <= e["begin"] <= e["end"] <= len(text):
            good.append(e)
            done = e["end"]
    if text.isascii():
        return [(e["begin"], e["end"], (e["text"] or "").encode()) for e in good], len(edits or []) - len(good)
    found, chars, size = [], 0, 0
    for e in good:
        begin = size + len(text[chars : e["begin"]].encode())
        size = begin + len(text[e["begin"] : e["end"]].encode())
        chars = e["end"]
        found.append((begin, size, (e["text"] or "").encode()))
    return found, len(edits or []) - len(good)


def _updating(path: str, columns: list[str], text: str, edits: str, prefix: str) -> Callable[[Batches], Batches]:
    at, edits_at = columns.index(text), columns.index(edits)
    trees_at = [columns.index(prefix + c) for c in _TREES]
    names = [*columns, *(prefix + c for c in _TOLD)]

    def run(batches: Batches) -> Batches:
        coder = encoder(path)
        for chunk in chunks(batches, at):
            arrays = {i: chunk.column(i).to_pylist() for i in (at, edits_at, *trees_at)}
            told: list[list[int]] = [arrays[trees_at[2]][:], [], [], []]
            for i in range(chunk.num_rows):
                value, wanted = arrays[at][i], arrays[edits_at][i]
                found, skipped = in_bytes(value, wanted) if value is not None else ([], len(wanted or []))
                encoded = 0
                if found:
                    sizes, tokens = (np.frombuffer(arrays[t][i], "<i8").copy() for t in trees_at[:2])
                    tree = TokenTree(value.encode(), sizes, tokens, coder.count)
                    for begin, end, new in reversed(found):
                        tree.edit(begin, end, new)
                    encoded = tree.encoded
                    for t, new in zip((at, *trees_at), (tree.text().decode(), sizes.tobytes(), tokens.tobytes(), int(tokens[1]))):
                        arrays[t][i] = new
                for column, n in zip(told[1:], (len(found), skipped, encoded)):
                    column.append(n)
            out = [pa.array(arrays[i], chunk.schema.field(i).type) if i in (at, *trees_at) else chunk.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*out, *(pa.array(c, pa.int64()) for c in told)], names=names)

    return run


def update(state: DataFrame, tokenizer: str | None = None, text: str = "text", edits: str = "edits", prefix: str = "") -> DataFrame:
    """``state`` after its edits: text, trees and n_tokens are new; further columns tell what was done.

    ``n_tokens_before``, ``n_edits`` taken, ``n_skipped``, and ``n_encoded``: words that were encoded again.
    """
    _refuse(state.columns, _TOLD, prefix)
    run = _updating(tokenizer or default_tokenizer(), state.columns, text, edits, prefix)
    return state.mapInArrow(run, extended(state.schema, **{prefix + c: "bigint" for c in _TOLD}))


def build_and_update(
    docs: DataFrame, find: Callable[[str], list[dict]], tokenizer: str | None = None, text: str = "text", prefix: str = ""
) -> DataFrame:
    """``update`` of ``build`` with the edits that ``find`` makes of each text, in one Python process a task."""
    _refuse(docs.columns, ("edits", *_TREES, *_TOLD), prefix)
    path, columns, at = tokenizer or default_tokenizer(), docs.columns, docs.columns.index(text)
    edits = prefix + "edits"
    building = _building(path, [*columns, edits], text, prefix)
    updating = _updating(path, [*columns, edits, *(prefix + c for c in _TREES)], text, edits, prefix)

    def finding(batches: Batches) -> Batches:
        for chunk in chunks(batches, at):
            made = [find(t or "") for t in chunk.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(made, _EDITS)], names=[*columns, edits])

    added = {edits: EDITS} | {prefix + c: t for c, t in _TREES.items()} | {prefix + c: "bigint" for c in _TOLD}
    return docs.mapInArrow(lambda batches: updating(building(finding(batches))), extended(docs.schema, **added))


_MAIL = re.compile(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBER = re.compile(r"\d(?:[ .-]?\d){6,}")


def cleaning_edits(text: str) -> list[dict]:
    """Edits a cleaning step makes: addresses and long numbers masked, lines seen before dropped."""
    found, seen, begin = [], set(), 0
    for line in text.split("\n"):
        if line in seen and line.strip():
            found.append((begin, min(begin + len(line) + 1, len(text)), ""))
        else:
            seen.add(line)
            if "@" in line:
                found += [(begin + m.start(), begin + m.end(), "<mail>") for m in _MAIL.finditer(line)]
            found += [(begin + m.start(), begin + m.end(), "<number>") for m in _NUMBER.finditer(line)]
        begin += len(line) + 1
    return [{"begin": b, "end": e, "text": t} for b, e, t in found]
