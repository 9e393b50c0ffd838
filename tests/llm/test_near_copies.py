from __future__ import annotations

import hashlib
import os
import random
import re
import time
from collections import defaultdict

import llm_data as data
import numpy as np
import pytest
from pyspark.sql import functions as F

from membertide.llm import line_dedup, ngram_join, substring_dedup
from membertide.llm.common import Scratch


@pytest.fixture(scope="module")
def rows():
    return data.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, data.SCHEMA).repartition(3)


def brute_components(rows, percent=90, width=3):
    sets = [data.shingles(r[1], width) for r in rows]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    roots = data.union_find(len(rows), links)
    smallest = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            smallest[root] = min(smallest.get(root, r[0]), r[0])
    return sorted(
        (str(r[0]), len(s), str(smallest.get(root) if s else r[0])) for r, s, root in zip(rows, sets, roots)
    )


def test_ngram_components_equal_brute_force(spark, docs, rows):
    found = ngram_join.join_components(docs, Scratch(spark)).collect()
    assert sorted((str(r.doc_id), r.n, str(r.component_id)) for r in found) == brute_components(rows)


def scattered(seed, count=420):
    """Texts of 1 to 250 words with edits, so that similarities lie on both sides of the limits and sizes in many bands."""
    rng, rows = random.Random(seed), []
    while len(rows) < count:
        base = data.prose(rng, rng.choice([1, 2, 4, 9, 12, 30, 31, 60, 120, 250]), rng.choice([3, 2000]))
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 15) + 1)):
                copy[rng.randrange(len(copy))] = "e%d" % rng.randrange(10**6)
            rows.append((len(rows) * 7 % 100_003, " ".join(copy[rng.randrange(0, 2) :] + base[: rng.randrange(0, 3)]), None, None, None, None, None))
    return rows


@pytest.mark.parametrize(("width", "percent", "tile"), [(3, 90, 2048), (5, 80, 2048), (5, 80, 3)])
def test_components_across_bands_equal_brute_force(spark, monkeypatch, width, percent, tile):
    monkeypatch.setattr(ngram_join, "TILE_SETS", tile)
    rows = scattered(width * percent)
    docs = spark.createDataFrame(rows, data.SCHEMA).repartition(4)
    found = ngram_join.join_components(docs, Scratch(spark), width=width, percent=percent).collect()
    want = brute_components(rows, percent, width)
    assert sorted((str(r.doc_id), r.n, str(r.component_id)) for r in found) == want
    assert 50 < sum(str(i) != c for i, n, c in want)


def candidates(spark, texts, percent=90):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    bands = ngram_join.Bands(percent)
    signed = ngram_join.signatures(docs, 3, bands, "doc_id", "text")
    return ngram_join.key_edges(docs, signed.agg({"n_keys": "sum"}).first()[0], 3, bands, "text").count()


@pytest.mark.parametrize("percent", [90, 80])
def test_candidates_of_short_texts_do_not_grow_with_their_square(spark, percent):
    few, many = (candidates(spark, [f"word{i}" for i in range(n)], percent) for n in (5000, 20_000))
    assert many <= 5 * few + 50
    rng = random.Random(2)
    few, many = (candidates(spark, [" ".join(data.prose(rng, 4, 10**6)) for _ in range(n)], percent) for n in (1000, 4000))
    assert many <= 5 * few + 50


def test_candidates_of_long_texts_do_not_grow_with_their_square(spark):
    rng = random.Random(5)
    few, many = (candidates(spark, [" ".join(data.prose(rng, 1000, 10**6)) for _ in range(n)]) for n in (40, 160))
    assert many <= 5 * few + 50


def test_a_million_shingles_under_a_small_tile(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_BYTES", 1 << 20)
    rng = random.Random(6)
    base = [str(rng.randrange(10**9)) for _ in range(10**6)]
    texts = [" ".join(base), " ".join([*base[:940_000], *map(str, range(50_000))]), " ".join([*base[:970_000], *map(str, range(40_000))])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    found = ngram_join.join_components(docs, Scratch(spark)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(0, 0), (1, 0), (2, 0)]


def test_small_tiles_lose_nothing(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_SETS", 3)
    found = ngram_join.join_components(docs, Scratch(spark)).collect()
    assert sorted((str(r.doc_id), r.n, str(r.component_id)) for r in found) == brute_components(rows)


def test_linked_sets_share_a_segment():
    rng, bands = random.Random(3), ngram_join.Bands()
    for _ in range(400):
        n = rng.choice([9, 10, 11, 19, 20, 50, 300, 2000])
        base = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))
        union = n
        drop = rng.randint(0, union // 10)
        other = base[drop:]
        if not bands.linked(len(other), len(base), len(other)):
            continue
        keys = []
        for s in (base, other):
            band = int(bands.of(np.array([len(s)]))[0])
            own = [ngram_join.segment_keys(s, band, bands)]
            if band and len(s) <= bands.reach(band - 1):
                own.append(ngram_join.segment_keys(s, band - 1, bands))
            keys.append(set(np.concatenate(own).tolist()))
        assert keys[0] & keys[1]


def test_bitmaps_never_rule_out_a_link():
    rng, bands = random.Random(4), ngram_join.Bands()
    base = np.unique(np.array([rng.getrandbits(64) for _ in range(400)], np.uint64))
    sets = [np.sort(np.concatenate((base[np.array(rng.sample(range(400), 400 - k))], np.array([rng.getrandbits(64) for _ in range(k)], np.uint64)))) for k in range(0, 60, 3)]
    band = int(bands.of(np.array([400]))[0])
    maps = [ngram_join.bitmap(s, bands.bits(band)) for s in sets]
    n = len(sets)
    found = ngram_join.tile_pairs(np.array([len(s) for s in sets]), np.arange(n), np.arange(n), np.ones(n, bool), maps, np.zeros(n, int), bands.bits(band), bands)
    pairs = set(zip(*(f.tolist() for f in found)))
    for i in range(n):
        for j in range(i + 1, n):
            if bands.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                assert (i, j) in pairs
    assert len(pairs) < n * (n - 1) / 2


def test_keep_one_keeps_the_smallest_of_each_group(spark, docs, rows):
    kept = ngram_join.keep_one(docs, Scratch(spark))
    assert kept.columns == docs.columns
    want = {(i, r[1]) for r in rows for i in [r[0]] if not data.shingles(r[1])}
    ids = {c for i, n, c in brute_components(rows) if n}
    found = {(r.doc_id, r.text) for r in kept.collect()}
    assert {k for k in found if not data.shingles(k[1])} == want
    assert {str(i) for i, t in found if data.shingles(t)} == ids


def brute_substrings(rows, window=13):
    first = {}
    for doc, text, *_ in rows:
        w = data.words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text, *_ in rows:
        w = data.words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(doc), len(w), len(gone), kept))
    return sorted(out)


@pytest.mark.parametrize("window", [13, 50, 3])
def test_substrings_equal_brute_force(spark, docs, rows, window):
    found = substring_dedup.dedup_substrings(docs, Scratch(spark), window).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found) == brute_substrings(rows, window)


def test_levels_double():
    assert substring_dedup.levels(13) == [7, 13]
    assert substring_dedup.levels(50) == [7, 13, 25, 50]


def test_every_run_holds_a_chosen_place():
    rng = np.random.default_rng(1)
    for width in (1, 2, 7, 13):
        for n in (width, width + 1, 100):
            values = rng.integers(0, 9, n).astype(np.uint64)
            at = set(substring_dedup.chosen(values, width).tolist())
            for i in range(n - width + 1):
                assert any(p in at and values[p] == values[i : i + width].min() for p in range(i, i + width))


def line_shingles(line):
    """The shingles at every character, of lines with one that is no space."""
    if not re.search(r"[^\x20\x09-\x0D]", line):
        return set()
    return {line[i : i + line_dedup.WIDTH] for i in range(max(1, len(line) - line_dedup.WIDTH + 1))}


def test_lines_equal_brute_force(spark, docs, rows):
    places = []
    for number, (doc, text, *_) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            if line_shingles(line):
                places.append((number, i, line))
    sets = [line_shingles(p[2]) for p in places]
    links = [(i, j) for i in range(len(places)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    roots = data.union_find(len(places), links)
    version = {r.text: r.v for r in docs.selectExpr("text", "xxhash64(coalesce(text, ''), text IS NULL) AS v").distinct().collect()}
    order = lambda p: (rows[p[0]][0] is not None, rows[p[0]][0] or 0, version[rows[p[0]][1]], p[1])
    stays = {}
    for p, root in zip(places, roots):
        stays[root] = min(stays.get(root, order(p)), order(p))
    gone = defaultdict(set)
    for p, root in zip(places, roots):
        if order(p) != stays[root]:
            gone[p[0]].add(p[1])
    want = []
    for number, (doc, text, *_) in enumerate(rows):
        left = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[number])
        want.append((str(doc), len(gone[number]), str(left)))
    out = line_dedup.dedup_lines(docs, Scratch(spark), removed="gone")
    assert out.columns == [*docs.columns, "gone"]
    assert sorted((str(r.doc_id), r.gone, str(r.text)) for r in out.collect()) == sorted(want)


@pytest.mark.parametrize("rows_sent", [0, 400_000])
def test_verification_reads_the_texts_once(spark, monkeypatch, rows_sent):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", rows_sent)
    scratch, rng = Scratch(spark), random.Random(5)
    lines = [data.prose(rng, 12, 10**3) for _ in range(6)]
    lines = [" ".join(words) if isinstance(words, list) else words for words in lines]
    lines += [lines[0] + "x", lines[1][:-2], lines[0], "short", "short!"]
    table = scratch.table(spark.createDataFrame(list(enumerate(lines)), "a bigint, line string"), "texts")
    every = [(x, y) for y in range(len(lines)) for x in range(y)]
    links = line_dedup.verified(scratch.table(spark.createDataFrame(every, "x bigint, y bigint"), "pairs"), table, 0.8)
    sets = [line_shingles(line) for line in lines]
    assert {(r.a, r.b) for r in links.collect()} == {(x, y) for x, y in every if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])} != set()
    plan = links._jdf.queryExecution().analyzed().toString()
    assert len(re.findall(r"Relation \[a#\d+L?,line#\d+\]", plan)) == 1


def test_residual_pairs_are_verified_as_far_as_they_can_change_a_component(spark, monkeypatch):
    rng, asked = random.Random(8), []
    groups = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(40)) for _ in range(3)]
    lines = {100 * g + i: f"{line} {i:02d}" for g, line in enumerate(groups) for i in range(20)}
    lines |= {300 + i: f"{groups[2][: 120 + 8 * i]} " + "".join(rng.choice("qrstuvwxyz") for _ in range(160 - 8 * i)) for i in range(20)}
    root = {a: a if a % 100 >= 15 or a >= 300 else a // 100 * 100 for a in lines}
    every = [(x, y, *sorted((root[x], root[y])), y - x) for x in lines for y in lines if x < y and root[x] != root[y] and (x // 100 == y // 100 or x // 100 == 2)]
    scratch, verify = Scratch(spark), line_dedup.verified
    texts = scratch.table(spark.createDataFrame(list(lines.items()), "a bigint, line string"), "texts")

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(line_dedup, "verified", counted)
    pairs = scratch.table(spark.createDataFrame(every, "x bigint, y bigint, lo bigint, hi bigint, apart int"), "left")
    links = {(r.a, r.b) for r in line_dedup.residual_links(pairs, texts, scratch, 0.8).collect()}
    sets, at = {a: line_shingles(line) for a, line in lines.items()}, {a: i for i, a in enumerate(lines)}
    all_links = {(x, y) for x, y, *_ in every if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])}
    own = [(at[a], at[r]) for a, r in root.items()]
    united = [data.union_find(len(lines), own + [(at[x], at[y]) for x, y in some]) for some in (links, all_links)]
    united = [[found.index(r) for r in found] for found in united]
    assert links < all_links and united[0] == united[1] and len(set(united[0])) < len(lines) - 50
    apart = sum(united[0][at[x]] != united[0][at[y]] for x, y, *_ in every)
    assert apart < sum(asked) < 0.8 * len(every) and max(asked) <= 2 * len(lines)
    assert not any(name.startswith(("left", "chosen")) for name in os.listdir(scratch.root.removeprefix("file:")))


def test_long_lines_are_ruled_out_before_their_shingles_are_made(spark, monkeypatch):
    rng, asked = random.Random(14), []
    fresh = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    lines = [fresh(5000) for _ in range(16)]  # their bitmaps of 1,024 bits are full
    lines += [line[:4800] + fresh(200) for line in lines[:3]] + [line[:3600] + fresh(1400) for line in lines[3:6]]
    lines += ["ab" * 3000, "ab" * 2700, "ab" * 2800 + fresh(30), "short line", "short lines"]
    sets = [line_shingles(line) for line in lines]
    every = [(x, y) for y in range(len(lines)) for x in range(y)]
    scratch, verify = Scratch(spark), line_dedup.verified
    texts = scratch.table(spark.createDataFrame(list(enumerate(lines)), "a bigint, line string"), "texts")
    counts = [(x, y, x, y, 0, *(max(1, len(lines[i]) - line_dedup.WIDTH + 1) for i in (x, y))) for x, y in every]
    pairs = spark.createDataFrame(counts, "x bigint, y bigint, lo bigint, hi bigint, apart int, n_x bigint, n_y bigint")
    pairs = scratch.table(pairs.selectExpr("x", "y", "lo", "hi", "apart", line_dedup._PIECES), "left")
    left, right = (line_dedup.shapes(texts).select(F.col("a").alias(end), *line_dedup._shape(f"_{end}")) for end in "xy")
    assert pairs.join(left, "x").join(right, "y").filter(line_dedup.possible(0.8)).count() > 100
    fine = line_dedup.fine_shapes(pairs, texts, scratch)

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(line_dedup, "verified", counted)
    links = {(r.a, r.b) for r in line_dedup.residual_links(pairs, texts, scratch, 0.8, fine).collect()}
    assert links == {(x, y) for x, y in every if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])} and len(links) >= 4
    assert sum(asked) < 20


def test_line_dedup_drops_tables_after_their_last_read(spark, docs):
    scratch = Scratch(spark)
    line_dedup.dedup_marks(docs, scratch).count()
    left = {name.rsplit("-", 1)[0] for name in os.listdir(scratch.root.removeprefix("file:"))}
    assert "lines" in left and not left & {"shared", "signed", "members", "texts", "shapes", "pairs", "links", "rest", "mixed", "left"}


def test_scratch_tables_leave_no_shuffle(spark):
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {b.name() for b in (blocks.apply(i) for blocks in [status.getAllBlocks()] for i in range(blocks.size())) if b.isShuffle()}
    before = shuffles()
    made = Scratch(spark).table(spark.range(100_000).groupBy((F.col("id") % 1009).alias("g")).count(), "counts")
    for _ in range(50):  # it is asked of the executors, not waited for
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before
    assert made.count() == 1009 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_line_dedup_runs_no_python(spark, docs):
    plan = line_dedup.dedup_lines(docs, Scratch(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert ngram_join.join_components(none, Scratch(spark)).count() == 0
    assert substring_dedup.dedup_substrings(none, Scratch(spark)).count() == 0
    assert line_dedup.dedup_lines(none, Scratch(spark)).count() == 0


def test_kept_words_hash(spark):
    text = "b a  b"
    row = substring_dedup.dedup_substrings(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), Scratch(spark)).first()
    assert hashlib.sha256(row.kept.encode()).hexdigest() == hashlib.sha256(b"b a b").hexdigest()


def template_lines(groups=150):
    """Pairs of near copies whose lines share a long part, 0.5 or so among all of them."""
    rng = random.Random(21)
    shared = data.prose(rng, 20, 10**3)
    lines = []
    for k in range(groups):
        own = ["%06d" % rng.randrange(10**6) for _ in range(8)]
        lines += [" ".join(shared + own), " ".join(shared + [*own[:7], "%06d" % rng.randrange(10**6)])]
    return lines


@pytest.mark.parametrize("key_lines", [20_000, 20])
def test_template_lines_lose_no_copy(spark, monkeypatch, key_lines):
    monkeypatch.setattr(line_dedup, "KEY_LINES", key_lines)
    monkeypatch.setattr(line_dedup, "TILE_LINES", 40)
    lines = template_lines()
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(3)
    out = line_dedup.dedup_lines(docs, Scratch(spark), removed="gone").collect()
    gone = {r.doc_id for r in out if r.gone}
    # 99 of 100 linked pairs share a key
    assert gone <= set(range(1, 300, 2)) and len(gone) >= 148


def gone_lines(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(3)
    return {r.doc_id for r in line_dedup.dedup_lines(docs, Scratch(spark), removed="gone").collect() if r.gone}


def test_short_lines_and_lines_without_spaces_are_judged(spark):
    long = "".join(chr(0x4E00 + 7 * i % 5000) for i in range(120))
    lines = ["Home", "Home", "about us", "about us", "Homer", " ", " ", "", "", "語", "語", long, long[:-2] + "別物", "a b " * 30, "a b " * 30]
    assert gone_lines(spark, lines) == {1, 3, 10, 12, 14}


def test_every_character_counts(spark):
    stems = ["wordnumber%02dwith" % i for i in range(12)]
    tails = [" ".join(s + "%010d" % (k * 10**8 + 7919 * i) for i, s in enumerate(stems)) for k in range(3)]
    words = ("the quick brown fox jumps over the lazy dog and then goes on to sleep in the warm barn " * 2).split()[:18]
    near = [" ".join(words), " ".join([*words[:-1], "warn"])]
    eight = ["alphabetical betamaxes gammaglobulin deltoids epsilons zetas etas thetaword", "alphabetical betamaxes gammaglobulin deltoids epsilons zetas etas thetaworm"]
    assert gone_lines(spark, [*tails, *near, *eight]) == {4, 6}


def test_sets_linked_at_80_percent_share_a_key():
    rng, bands = random.Random(8), ngram_join.Bands(80)
    for k in range(3000):
        n = 9 + k % 60 if k % 10 else 2000
        base = [rng.getrandbits(64) for _ in range(n)]
        gone = rng.randint(0, n // 9)
        sets = [np.unique(np.array(s, np.uint64)) for s in (base, base[gone:] + [rng.getrandbits(64) for _ in range(gone)])]
        if not bands.linked(n - gone, n, n):
            continue
        keys = []
        for s in sets:
            band = int(bands.of(np.array([n]))[0])
            keys.append(set(ngram_join.segment_keys(s, band, bands).tolist()))
        assert keys[0] & keys[1]


def test_empty_segments_are_no_keys_at_80_percent():
    rng, bands = np.random.default_rng(9), ngram_join.Bands(80)
    sets = [np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2)) for _ in range(30)]
    band = int(bands.of(np.array([300]))[0])
    keys = [set(ngram_join.segment_keys(s, band, bands).tolist()) for s in sets]
    assert not any(keys[i] & keys[j] for i in range(30) for j in range(i))


def similar_lines(count, seed=17):
    """Pairs of lines of 28 words with a similarity from 0.8 to 0.85."""
    rng, pairs = random.Random(seed), []
    while len(pairs) < count:
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(28)]
        other = list(words)
        other[rng.randrange(28)] = "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
        left, right = line_shingles(" ".join(words)), line_shingles(" ".join(other))
        if 0.8 <= len(left & right) / len(left | right) <= 0.85:
            pairs.append((" ".join(words), " ".join(other)))
    return pairs


def test_recall_of_links_near_the_limit(spark):
    pairs = similar_lines(400)
    gone = gone_lines(spark, [line for pair in pairs for line in pair])
    assert gone <= set(range(1, 800, 2)) and len(gone) >= 0.99 * 400


def test_line_bitmaps_never_rule_out_a_link(spark):
    pairs = similar_lines(60) + [("x" * 40, "x" * 33), ("short", "short"), ("ab" * 200, "ab" * 190 + "cd")]
    lines = spark.createDataFrame([(i, p[i % 2]) for i, p in enumerate(q for q in pairs for _ in (0, 1))], "a bigint, line string")
    shaped = line_dedup.shapes(lines)
    shape = {r.a: r for r in shaped.collect()}
    assert all(shape[i].n == max(1, len(p[i % 2]) - line_dedup.WIDTH + 1) for i, p in enumerate(q for q in pairs for _ in (0, 1)))
    left, right = (shaped.select(F.expr(f"a div 2 AS pair{s}"), *line_dedup._shape(f"_{s}")).filter(f"a % 2 = {k}") for k, s in enumerate("xy"))
    both = left.join(right, F.col("pairx") == F.col("pairy"))
    linked = {i for i, (x, y) in enumerate(pairs) if len(line_shingles(x) & line_shingles(y)) >= 0.8 * len(line_shingles(x) | line_shingles(y))}
    assert len(linked) >= 60
    assert linked <= {r.pairx for r in both.filter(line_dedup.possible(0.8)).collect()}


def test_written_pairs_of_template_lines_grow_with_the_lines(spark):
    counts = []
    for groups in (250, 1000):
        docs = spark.createDataFrame(list(enumerate(template_lines(groups))), "doc_id bigint, text string").repartition(4)
        scratch = Scratch(spark)
        signed = line_dedup.signatures(line_dedup.judged_lines(docs, "doc_id", "text"), line_dedup.BANDS)
        members = line_dedup.key_members(scratch.table(signed, "signed"), scratch)
        roots = members.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
        shaped = line_dedup.shapes(docs.selectExpr("xxhash64(text) AS a", "text AS line"))
        counts.append(line_dedup.residual_pairs(members, shaped, roots, scratch, 0.8).count() + line_dedup.first_pairs(members, shaped, 0.8).count())
    assert counts[1] <= 5 * counts[0] and counts[0] >= 250
