"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton's alphabet is words. A document's words stream through it; the state after a word
gives the longest suffix so far that occurs in an item. Where that length reaches the window, the
window's words are hit, and the state of exactly that length names the items. Words no item has
reset the automaton, so only runs long enough for a window are streamed.

Distinct items are dealt to blocks of ``BLOCK_BYTES`` of text by running size, one automaton each; a longer item is
a block of its own. One block is on the driver and in the tasks at a time, and a worker keeps its automaton from task to
task. A benchmark of one block takes one pass with no shuffle. Of several blocks each has a job of its own that
writes what it finds, once per distinct text with a hit; the hits are then joined to the documents by
the text's hash, broadcast up to a measured size.

Null texts have no words. A null item id still hits, but is not listed. Repeated items count
once. An empty table of items hits nothing, an empty table of documents gives no rows. Null document ids and repeated
rows are judged alike. A text of any length streams through whole, one at a time. Other columns pass through; names in
clash with what is added are refused, and ``prefix`` gives others.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import BROADCAST_BYTES, Scratch, chunks, extended, text_key, with_length

WINDOW = 13
BLOCK_BYTES = 1 << 20
#: Lower-cases A-Z and blanks all other ASCII but digits and a-z.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")

Item = tuple[str | None, str | None]


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


class ItemAutomaton:
    """Substrings of all items; ``match`` gives hit positions and items of a sequence of words."""

    def __init__(self, items: list[Item], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in normal_words(text)]
            if words:
                coded.append((name, words))
                last = 0
                for word in words:
                    last = self._extend(last, word)
        self.shortest = min((min(len(w), window) for _, w in coded), default=window)
        #: For a state the items whose window ends there; for short items: length and items.
        self.items: dict[int, set[str | None]] = {}
        self.short: dict[int, dict[int, set[str | None]]] = {}
        for name, words in coded:
            self._mark(name, words)
        self._settle()

    def _extend(self, last: int, word: int) -> int:
        following, link, length = self.next, self.link, self.length
        known = following[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._clone(last, word, known)
        state = self._state({}, length[last] + 1, 0)
        while last != -1 and word not in following[last]:
            following[last][word] = state
            last = link[last]
        if last != -1:
            known = following[last][word]
            link[state] = known if length[known] == length[last] + 1 else self._clone(last, word, known)
        return state

    def _state(self, following: dict[int, int], length: int, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, last: int, word: int, known: int) -> int:
        copy = self._state(dict(self.next[known]), self.length[last] + 1, self.link[known])
        self.link[known] = copy
        while last != -1 and self.next[last].get(word) == known:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def _mark(self, name: str | None, words: list[int]) -> None:
        state = 0
        for at, word in enumerate(words, 1):
            state = self.next[state][word]
            while self.length[self.link[state]] >= self.window:
                state = self.link[state]
            if at >= self.window:
                self.items.setdefault(state, set()).add(name)
        if len(words) < self.window:
            self.short.setdefault(state, {}).setdefault(len(words), set()).add(name)

    def _settle(self) -> None:
        """For each state: the one of its suffix of window length, and its marked suffixes."""
        self.of_window, self.marked = [0] * len(self.next), [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.link[state]
            self.of_window[state] = self.of_window[above] if self.length[above] >= self.window else state
            own = tuple((n, state) for n in self.short.get(state, ()))
            self.marked[state] = own + self.marked[above]

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Merged spans of hit words, ends excluded, and the ids of the items."""
        get = self.vocabulary.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (codes >= 0).astype(np.int8), [0]))))
        begins, ends = edges[::2], edges[1::2]
        long = ends - begins >= self.shortest
        spans: list[tuple[int, int]] = []
        windows, names = set(), set()
        for begin, end in zip(begins[long].tolist(), ends[long].tolist()):
            self._stream(codes[begin:end].tolist(), begin, spans, windows, names)
        for state in windows:
            names |= self.items[state]
        return merged(spans), names

    def _stream(self, run: list[int], at: int, spans: list, windows: set, names: set) -> None:
        following, link, lengths = self.next, self.link, self.length
        of_window, marked, window = self.of_window, self.marked, self.window
        state = length = 0
        for word in run:
            at += 1
            onward = following[state].get(word)
            while onward is None:  # every word here is in some item, so the root has it
                state = link[state]
                length = lengths[state]
                onward = following[state].get(word)
            state = onward
            length += 1
            if length >= window:
                windows.add(of_window[state])
                spans.append((at - window, at))
            for n, owner in marked[state]:
                if n <= length:
                    names |= self.short[owner][n]
                    spans.append((at - n, at))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(_NORMAL))]
    kept, done = [], 0
    for begin, end in spans:
        kept.append(raw[done : places[begin][0]])
        done = places[end - 1][1]
    return b"".join([*kept, raw[done:]]).decode()


#: Bins per block that distinct items are dealt to by hash before bins are put together by size.
BINS = 8


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[Item]]:
    """The distinct items in blocks of bounded size, one at a time."""
    sized = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).distinct()
    weight = F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1)
    total = sized.agg(weight).first()[0] or 0
    if total <= BLOCK_BYTES:
        yield [tuple(r) for r in sized.collect()]
        return
    bin_ = F.pmod(F.xxhash64("id", "text"), F.lit(BINS * -(-total // BLOCK_BYTES)))
    block, size = [], 0
    for number, own in chain(sorted(tuple(r) for r in sized.groupBy(bin_.alias("bin")).agg(weight).collect()), [(None, BLOCK_BYTES + 1)]):
        if block and size + own > BLOCK_BYTES:
            yield [tuple(r) for r in sized.filter(bin_.isin(block)).collect()]
            block, size = [], 0
        block.append(number)
        size += own


_kept: dict[tuple, ItemAutomaton] = {}


def _automaton(block: list[Item], window: int) -> ItemAutomaton:
    """The block's automaton, the last one of which the worker process keeps."""
    key = (window, hash(tuple(block)), len(block))
    if key not in _kept:
        _kept.clear()
        _kept[key] = ItemAutomaton(block, window)
    return _kept[key]


Batches = Iterator[pa.RecordBatch]
_FOUND = {"n_words": "bigint", "spans": "array<struct<begin:bigint,end:bigint>>", "item_ids": "array<string>"}
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _finding(block: list[Item], window: int, columns: list[str], text: str, prefix: str) -> Callable[[Batches], Batches]:
    """A pass with a block's automaton over rows of ``columns``."""
    at, names = columns.index(text), [*columns, *(prefix + c for c in _FOUND)]

    def run(batches: Batches) -> Batches:
        automaton = _automaton(block, window)
        for chunk in chunks(batches, at):
            counts, spans, found = [], [], []
            for value in chunk.column(at).to_pylist():
                words = normal_words(value)
                own, ids = automaton.match(words)
                ids.discard(None)
                counts.append(len(words))
                spans.append([{"begin": b, "end": e} for b, e in own])
                found.append(sorted(ids))
            made = [pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*chunk.columns, *made], names=names)

    return run


def _hits_only(find: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in find(batches):
            hit = pa.array([len(s) > 0 for s in batch.column("spans").to_pylist()], pa.bool_())
            yield batch.select(["version", "spans", "item_ids"]).filter(hit)

    return run


def _merging(columns: list[str], text: str, prefix: str) -> Callable[[Batches], Batches]:
    """A pass over rows that have the lists of all blocks' spans and items behind their ``columns``."""
    at, width, names = columns.index(text), len(columns), [*columns, *(prefix + c for c in _FOUND)]

    def run(batches: Batches) -> Batches:
        for chunk in chunks(batches, at):
            counts = [len(normal_words(value)) for value in chunk.column(at).to_pylist()]
            spans = [merged([(s["begin"], s["end"]) for s in own or ()]) for own in chunk.column(width).to_pylist()]
            ids = [sorted(set(own or ())) for own in chunk.column(width + 1).to_pylist()]
            made = [pa.array(counts, pa.int64()), pa.array([[{"begin": b, "end": e} for b, e in own] for own in spans], _SPANS)]
            yield pa.RecordBatch.from_arrays([*chunk.columns[:width], *made, pa.array(ids, pa.list_(pa.string()))], names=names)

    return run


def _passes(docs: DataFrame, items: DataFrame, window: int, item_id: str, item_text: str, text: str, prefix: str, scratch: Scratch | None):
    """Rows, the function of their one Python pass, and the schema it gives."""
    if taken := [prefix + c for c in _FOUND if prefix + c in docs.columns]:
        raise ValueError(f"choose another prefix: {taken} are columns of the input")
    schema = extended(docs.schema, **{prefix + c: t for c, t in _FOUND.items()})
    blocks = item_blocks(items, item_id, item_text)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return docs, _finding(first, window, docs.columns, text, prefix), schema
    scratch, found = scratch or Scratch(docs.sparkSession), None
    version = text_key(F.col(f"`{text}`"))
    texts = docs.select(version.alias("version"), F.col(f"`{text}`").alias("text"))
    for block in chain([first, second], blocks):
        find = _hits_only(_finding(block, window, ["version", "text"], "text", ""))
        hits = texts.mapInArrow(find, f"version bigint, spans {_FOUND['spans']}, item_ids {_FOUND['item_ids']}")
        part = scratch.table(hits.dropDuplicates(["version"]), "hits")
        found = part if found is None else found.union(part)
    lists = [F.flatten(F.collect_list(c)).alias(prefix + c) for c in ("spans", "item_ids")]
    every = scratch.table(found.groupBy(F.col("version").alias("__version")).agg(*lists), "every")
    size = every.agg(F.sum(F.size(prefix + "spans") * 16 + F.length(F.array_join(prefix + "item_ids", ",")) + 64)).first()[0] or 0
    every = F.broadcast(every) if size <= BROADCAST_BYTES else every
    rows = docs.join(every, version == F.col("__version"), "left").drop("__version")
    return rows, _merging(docs.columns, text, prefix), schema


def find_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, item_id: str = "item_id", item_text: str = "text", text: str = "text", prefix: str = "",
    scratch: Scratch | None = None,
) -> DataFrame:
    """``docs`` with n_words, spans (of hit words, ends excluded) and item_ids, under ``prefix``."""
    out, last, schema = _passes(docs, items, window, item_id, item_text, text, prefix, scratch)
    return out.mapInArrow(last, schema)


def hit_count(spans: str) -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda total, s: total + s.end - s.begin)


def contaminated(n_hit: F.Column, n_words: F.Column, coverage: int = 20) -> F.Column:
    """Whether the hit words are at least one in ``coverage``."""
    return (n_hit > 0) & (coverage * n_hit >= n_words)


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = 20, item_id: str = "item_id", item_text: str = "text", text: str = "text",
    scratch: Scratch | None = None,
) -> DataFrame:
    """Without documents whose coverage reaches the limit (``contaminated``), and without the spans in the others.

    Every span has at least a window's words, or is a whole short item. A column ``n_chars`` of
    integers follows the text.
    """
    prefix = "__hits_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    out, last, _ = _passes(docs, items, window, item_id, item_text, text, prefix, scratch)
    columns, at = docs.columns, docs.columns.index(text)

    def run(batches: Batches) -> Batches:
        for batch in last(batches):
            texts, totals, spans = (batch.column(i).to_pylist() for i in (at, len(columns), len(columns) + 1))
            hits = [sum(s["end"] - s["begin"] for s in own) for own in spans]
            stays = [not n or coverage * n < total for n, total in zip(hits, totals)]
            new = [cut(t, [(x["begin"], x["end"]) for x in s]) if s and stay else t for t, s, stay in zip(texts, spans, stays)]
            arrays = [pa.array(new, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(stays))

    return with_length(out.mapInArrow(run, docs.schema), text)
