from __future__ import annotations

import hashlib
import random

import llm_data as data
import numpy as np
import pytest
from pyspark.sql import functions as F

from membertide.llm import merkle, ranks, sha_states
from membertide.llm.common import Scratch

SCHEMA = "doc_id bigint, lang string, leaf string, changed string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_over(nodes: list[str], fanout: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def brute(rows, fanout):
    """(id, leaf, subroot, root, proof, folded) of each row, by whole trees in memory."""
    langs = sorted({r[1] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees, order = {}, {}
    for g in langs:
        order[g] = sorted((r for r in rows if r[1] == g), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[g] = levels_over([r[2] for r in order[g]], fanout)
    crown = levels_over([trees[g][-1][0] for g in langs], fanout)
    out = []
    for number, g in enumerate(langs):
        for place, row in enumerate(order[g]):
            folded, proof = row[3] or row[2], ""
            for levels, at in ((trees[g], place), (crown, number)):
                for level in levels[:-1]:
                    begin = at - at % fanout
                    run = level[begin : begin + fanout]
                    proof += "".join(x for i, x in enumerate(run) if i != at - begin)
                    run[at - begin] = folded
                    folded, at = h(*run), at // fanout
            out.append((str(row[0]), row[2], trees[g][-1][0], crown[-1][0], h(proof), folded))
    return sorted(out)


def made(seed, sizes):
    rng, rows = random.Random(seed), []
    for lang, n in sizes.items():
        for i in range(n):
            doc = None if i % 50 == 7 else rng.randrange(10**4)
            rows.append((doc, lang, h(str(rng.random())), h("other", str(i)) if i % 3 == 0 else None))
    rng.shuffle(rows)
    return [*rows, rows[0], rows[1]]


@pytest.mark.parametrize(("fanout", "height"), [(2, 12), (2, 2), (3, 1), (5, 2)])
def test_trees_equal_brute_force(spark, fanout, height):
    rows = made(fanout, {None: 9, "de": 133, "en": 64, "": 1, "fr": 2, "ÿ": 17, "\U0001f600": 5})
    leaves = spark.createDataFrame(rows, SCHEMA).repartition(5)
    scratch = Scratch(spark)
    found = merkle.fold(merkle.build(leaves, scratch, replaced="changed", fanout=fanout, height=height), scratch).collect()
    assert sorted((str(r.id), r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in found) == brute(rows, fanout)


def test_one_leaf_is_the_root_and_an_empty_table_has_none(spark):
    leaf = h("x")
    for rows in ([(1, None, leaf, None)], []):
        scratch = Scratch(spark)
        found = merkle.fold(merkle.build(spark.createDataFrame(rows, SCHEMA), scratch), scratch).collect()
        assert [(r.leaf, r.subroot, r.root, r.folded_root, r.proof) for r in found] == [(leaf, leaf, leaf, leaf, h())] * len(rows)


def test_folding_reads_no_left_sibling():
    nodes = sha_states.words(b"".join(hashlib.sha256(bytes([i])).digest() for i in range(7)))
    block = merkle.Block.build(nodes, 2, 3)
    want = block.digests[-1][:, 0].tolist()
    digest = nodes
    for step in block.steps():
        left = np.arange(3)[:, None] < step.slot
        step.run = np.where(left, np.uint32(0), step.run)
        digest = step.folded(digest)
    assert all(digest[:, i].tolist() == want for i in range(7))


def test_states_give_the_hash_of_the_standard_library():
    rng = random.Random(1)
    raw = [bytes(rng.randrange(256) for _ in range(32)) for _ in range(5)]
    texts = sha_states.hex_block(sha_states.words(b"".join(raw)))
    state = sha_states.INITIAL
    for i in range(5):
        state = sha_states.absorbed(state, texts[:, i : i + 1])
    whole = hashlib.sha256("".join(r.hex() for r in raw).encode()).digest()
    assert sha_states.raw_bytes(sha_states.closed(state, np.array([5]))) == whole


def test_leaf_tells_nulls_empties_and_bounds_apart(spark):
    rows = [(None, None), (None, ""), ("", None), ("a", "b"), ("ab", ""), ("1:a", None), ("é", "-"), ("é" * 70000, "x")]
    found = spark.createDataFrame(rows, "x string, y string").select(merkle.leaf(["x", "y"]).alias("d")).collect()
    part = lambda v: "-" if v is None else f"{len(v.encode())}:{v}"
    assert [r.d for r in found] == [h(part(x), part(y)) for x, y in rows]


def test_ranks_need_no_window_over_a_group(spark):
    rows = [(g, i) for g, n in (("a", 900), ("b", 3), ("c", 1)) for i in range(n)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int").repartition(7)
    out = ranks.ranked(df, ["g"], [F.asc("i")], Scratch(spark))
    found = out.collect()
    assert all(r.position == r.i for r in found) and {r.g: r.total for r in found} == {"a": 900, "b": 3, "c": 1}
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_query_equals_brute_force_on_hostile_rows(spark, tmp_path):
    from membertide.llm import queries

    rows = [(r[0], None if i % 9 == 0 else "l%d" % (i % 3), r[1], r[2], r[3], "x") for i, r in enumerate(data.documents())]
    schema = "doc_id bigint, lang string, text string, source string, n_chars int, leaf string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")

    def digest(doc, lang, text, source, n):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))

    import zlib

    leaves = []
    for doc, lang, text, source, n, _ in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
        leaves.append((doc, lang, digest(doc, lang, text, source, n), digest(doc, lang, text, source, n + 1) if hit else None))
    found = queries.op11_merkle(spark, str(tmp_path)).collect()
    got = sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in found)
    assert got == brute(leaves, 2)
    assert all(r.verified == (r.folded_root == r.root) for r in found) and {r.verified for r in found} == {True, False}
