from __future__ import annotations

import random

import llm_data as data
import numpy as np
import pytest

from membertide.llm import parse_dedup
from membertide.llm.common import Scratch

SCHEMA = "doc_id bigint, text string, spans string, doc string"


def brute(rows, length):
    """(id, bytes, removed, spans, kept) with ids null first and equal rows as one document."""
    order = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows}, key=lambda k: (k[:2], rank(k[2])))
    first = {}
    for number, (_, _, text) in enumerate(order):
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], (number, i))
    number_of = {k: n for n, k in enumerate(order)}
    out = []
    for doc, text, *_ in rows:
        raw, number = (text or "").encode(), number_of[(doc is not None, doc or 0, text)]
        gone = np.zeros(len(raw) + 2, bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < (number, i):
                gone[i + 1 : i + length + 1] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        kept = bytes(b for i, b in enumerate(raw) if not gone[i + 1])
        out.append((str(doc), len(raw), len(raw) - len(kept), spans, kept))
    return sorted(out)


_versions: dict = {}


def rank(text):
    return _versions[text]


def compare(spark, rows, length, **kwargs):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    _versions.update({r.text: r.v for r in docs.selectExpr("text", "xxhash64(coalesce(text, ''), text IS NULL) AS v").distinct().collect()})
    found = parse_dedup.dedup_bytes(docs, Scratch(spark), length).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, [(s.begin, s.end) for s in r.spans], bytes(r.kept)) for r in found)
    assert got == brute(rows, length)
    return got


def small_alphabet(seed):
    rng, rows = random.Random(seed), []
    for i in range(40):
        rows.append((i * 3 % 41, "".join(rng.choice("ab") for _ in range(rng.randrange(120))), None, None))
    return [*rows, (50, "a" * 500, None, None), (51, "ab" * 300, None, None), (52, "é" * 90 + "x", None, None)]


@pytest.mark.parametrize("length", [2, 5, 9, 16])
def test_small_alphabets_equal_brute_force(spark, length):
    got = compare(spark, small_alphabet(length), length)
    assert sum(g[2] for g in got) > 100


def test_hostile_rows_equal_brute_force(spark):
    rows = [(r[0], r[1], "x", None) for r in data.documents()]
    got = compare(spark, rows, 100)
    assert any(len(g[3]) > 1 for g in got) and any(not g[3] for g in got)


def test_unique_ids_need_no_ranks(spark):
    rows = {r[0]: (r[0], r[1], None, None) for r in data.documents(8) if r[0] is not None}
    compare(spark, list(rows.values()), 100)


def near_copies(seed=4, copies=25):
    """One text with scattered edits, so that every trigger is near an edge in some copy."""
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = []
    for i in range(copies):
        text = list(base)
        for at in rng.sample(range(len(base)), rng.randrange(0, 30)):
            text[at] = rng.choice(["X", "YZ", ""])
        begin = rng.randrange(400)
        rows.append((i, "".join(text)[begin : begin + rng.randrange(100, 3000)], None, None))
    return rows


@pytest.mark.parametrize("batch", [4 << 20, 3000])
def test_near_copies_equal_brute_force(spark, monkeypatch, batch):
    monkeypatch.setattr(parse_dedup, "BATCH", batch)
    monkeypatch.setattr(parse_dedup, "BUFFER", 2000)
    compare(spark, near_copies(), 100)


def test_long_texts_go_through_in_slices():
    text = "".join(random.Random(5).choice("abcd") for _ in range(30_000)).encode()

    def found(size):
        parse_dedup.SLICE, kept = size, parse_dedup.SLICE
        try:
            parts = [parse_dedup.Parse(b, 100).phrases() for b in parse_dedup.buffers(iter([(1, text, ()), (2, text[:50], ()), (3, text[:777], ())]), 100)]
        finally:
            parse_dedup.SLICE = kept
        return sorted(zip(*(np.concatenate(c).tolist() for c in zip(*parts))))

    whole = found(1 << 20)
    assert found(1000) == whole and len(whole) > 500


def test_every_string_holds_its_anchor():
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab") for _ in range(400)).encode(), b"a" * 300, b"x" * 100, b"y" * 99]
    buffer = next(parse_dedup.buffers(((i, t, ()) for i, t in enumerate(texts)), 100))
    parse = parse_dedup.Parse(buffer, 100)
    triggers = set(parse.triggers.tolist())
    for i in np.flatnonzero(parse.valid).tolist():
        run = parse.values[i : i + 51]
        assert i + int(run.argmin()) in triggers
    assert int(parse.valid.sum()) == 301 + 201 + 1


def test_a_shared_passage_is_a_row_per_batch(spark):
    """What a hot gram puts into its bucket does not grow with the documents of a batch."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij") for _ in range(600))
    texts = [(i, "".join(rng.choice("klmnop") for _ in range(150)) + passage + "".join(rng.choice("qrstuv") for _ in range(150)), None, None) for i in range(300)]
    parse = [parse_dedup.Parse(b, 100) for b in parse_dedup.buffers(((r[0], r[1].encode(), ()) for r in texts), 100)]
    grams, phrases, docs, places = (np.concatenate(c) for c in zip(*(p.phrases() for p in parse)))
    order, _, first, later = parse_dedup._first_places([grams, phrases], docs, places)
    inside = [g for g, n in zip(*np.unique(grams, return_counts=True)) if n == 300]
    assert len(inside) > 10
    compare(spark, texts[:60], 100)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert parse_dedup.dedup_bytes(docs, Scratch(spark)).collect() == []
