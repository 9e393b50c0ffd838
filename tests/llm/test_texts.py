from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import llm_data as data
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from membertide.llm import decontaminate, packing, repetition, sharding, token_counts, token_store, url_filter
from membertide.llm.common import Scratch
from membertide.llm.tokens import default_tokenizer, encoder

ROWS = data.documents()
ITEM = "What is the Capital of the most northern state, and how many people lived there in 1900?"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, data.SCHEMA).repartition(3)


def key(row):
    return tuple(str(x) for x in row)


# quality rules


def brute_quality(text, rules):
    w, n = data.words(text), len(data.words(text))

    def spread(size):
        where = defaultdict(list)
        for i in range(n - size + 1):
            where[tuple(w[i : i + size])].append(i)
        return len({p for at in where.values() if len(at) > 1 for i in at for p in range(i, i + size)})

    def repeats(size):
        seen = Counter(tuple(w[i : i + size]) for i in range(n - size + 1))
        return any(c > 1 for c in seen.values())

    lines = [x for x in (text or "").split("\n") if data.words(x)]
    failed = n < rules.min_words or 100 * spread(8) > rules.base_percent * n
    kept = not failed and 100 * spread(rules.min_repeat) <= rules.covered_percent * n and not repeats(rules.longest_repeat + 1)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), spread(8), failed, kept


def test_quality_equals_brute_force(docs):
    rules = repetition.Rules(longest_repeat=11)
    judged = repetition.judge(docs.drop("n_words", "kept"), rules)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    found = sorted(key([r.doc_id, *(r[c] for c in names)]) for r in judged.collect())
    assert found == sorted(key([r[0], *brute_quality(r[1], rules)]) for r in ROWS)
    assert not docs.sparkSession.createDataFrame([], data.SCHEMA).transform(repetition.filter_quality).count()


def test_quality_keeps_what_the_first_limits_keep(spark):
    rng = random.Random(3)
    fresh = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(n)]
    sixes, passage, longer = (fresh(n) for n in (6, 200, 401))
    kept = [sixes + fresh(5) + sixes + fresh(25), passage + fresh(100) + passage + fresh(1000)]  # 29 % in sixes, 27 % in one passage
    gone = [sixes + fresh(5) + sixes + fresh(7), longer + fresh(1) + longer + fresh(3000)]
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in enumerate(kept + gone)], "doc_id bigint, text string")
    judged = {r.doc_id: (r.base_failed, r.kept) for r in repetition.judge(docs).collect()}
    assert judged == {0: (False, True), 1: (False, True), 2: (False, False), 3: (False, False)}


def test_quality_filter_keeps_columns_and_refuses_a_clash(docs):
    assert repetition.filter_quality(docs).columns == docs.columns
    with pytest.raises(ValueError):
        repetition.judge(docs)


def test_longest_repeats_equal_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        n, least = rng.randrange(40), rng.choice([1, 2, 3, 6])
        codes = [rng.randrange(3) for _ in range(n)]
        want = []
        for i in range(n):
            best = 0
            for j in range(n):
                k = 0
                while i != j and max(i, j) + k < n and codes[i + k] == codes[j + k]:
                    k += 1
                best = max(best, k)
            want.append(best if best >= least else 0)
        assert repetition.longest_repeats(np.array(codes, np.int64), least).tolist() == want


# decontamination


def items():
    rng = random.Random(9)
    return [(1, ITEM), (2, "two words"), (3, None), (4, " ?! "), (5, " ".join(data.prose(rng, 40))), (10, ITEM), (None, "nameless item here"), (1, ITEM)]


def suspects():
    rng = random.Random(10)
    long = items()[4][1].split()
    texts = [None, "", ITEM.upper(), "x " * 100 + "Two, words!" + " y" * 90, " ".join(data.prose(rng, 300) + long[3:17] + data.prose(rng, 10))]
    texts += [" ".join(long[:12]), "nameless item here", "two", " ".join(data.prose(rng, 400) + long + data.prose(rng, 30)), "two wordś", ITEM + " é " + ITEM]
    return [(i, t, "s", 1) for i, t in enumerate(texts)] + [(3, "two words", None, None)]


def normal(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data.ascii_lower(text or ""))


def brute_hits(text):
    w, hit, found = normal(text), set(), set()
    for name, item in items():
        v = normal(item)
        size = min(13, len(v))
        for j in range(len(v) - size + 1) if v else ():
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[j : j + size]:
                    hit.update(range(i, i + size))
                    found.add(name)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_hits_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    bench = spark.createDataFrame(items(), "item_id int, text string")
    found = decontaminate.find_hits(spark.createDataFrame(suspects(), "doc_id int, text string, spans string, n_chars int"), bench, prefix="h_")
    got = sorted(key([r.doc_id, r.h_n_words, sum(s.end - s.begin for s in r.h_spans), r.h_item_ids]) for r in found.collect())
    assert got == sorted(key([r[0], *brute_hits(r[1])]) for r in suspects())


def test_decontaminate_drops_and_cuts(spark):
    bench = spark.createDataFrame(items(), "item_id int, text string")
    suspect = spark.createDataFrame(suspects(), "doc_id int, text string, spans string, n_chars int")
    clean = decontaminate.decontaminate(suspect, bench)
    assert clean.columns == suspect.columns
    kept = {r.text for r in clean.collect()}
    for _, text, *_ in suspects():
        n, hit, _ = brute_hits(text)
        if not hit:
            assert text in kept
        elif 20 * hit >= n:
            assert text not in kept
        else:
            assert text not in kept and any(k and k.split()[0] == text.split()[0] and brute_hits(k)[0] == n - hit for k in kept)
    nothing = decontaminate.find_hits(suspect.drop("spans"), bench.limit(0))
    assert all(r.spans == [] and r.item_ids == [] for r in nothing.collect())


def test_blocks_have_bounded_text_and_each_item_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    rng = random.Random(3)
    rows = [(i, " ".join(data.prose(rng, 60))) for i in range(100)]
    rows += [(500, rows[0][1])] * 60 + [(None, "null id"), (501, None)] + [(502, "long " * 1000)]
    bench = spark.createDataFrame(rows, "item_id int, text string").repartition(4)
    blocks = list(decontaminate.item_blocks(bench, "item_id", "text"))
    sizes = [sum(len((t or "").encode()) + 1 for _, t in b) for b in blocks]
    assert all(size <= 2000 or len({t for _, t in b}) < 15 for size, b in zip(sizes, blocks)) and sum(size > 2000 for size in sizes) <= 1
    found = [item for block in blocks for item in block]
    assert Counter(found) == Counter({(None if i is None else str(i), t) for i, t in rows})


def test_passes_do_not_chain(spark, monkeypatch):
    """Many blocks, an item in a third of all rows, and copies of a hit text: one Python node, same hits."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    bench = spark.createDataFrame(items() + [items()[0]] * 20, "item_id int, text string")
    rows = suspects() + [(900 + i, ITEM, None, None) for i in range(30)]
    suspect = spark.createDataFrame(rows, "doc_id int, text string, spans string, n_chars int").repartition(3)
    found = decontaminate.find_hits(suspect, bench, prefix="h_", scratch=Scratch(spark))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    got = sorted(key([r.doc_id, r.h_n_words, sum(s.end - s.begin for s in r.h_spans), r.h_item_ids]) for r in found.collect())
    assert got == sorted(key([r[0], *brute_hits(r[1])]) for r in rows)
    one = decontaminate.decontaminate(suspect, bench, scratch=Scratch(spark)).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1 << 20)
    assert sorted(map(key, one)) == sorted(map(key, decontaminate.decontaminate(suspect, bench).collect()))


# sharding


def brute_shard(doc, shards, seed=0):
    """The shard with the highest hash of id, shard and seed, as Spark's xxhash64 chains them; null leaves the hash as it is."""

    def hashed(s):
        h = 42 if doc is None else xxhash.xxh64_intdigest(struct.pack("<q", doc), seed=42)
        for number in (s, seed):
            h = xxhash.xxh64_intdigest(struct.pack("<i", number), seed=h)
        return h - (1 << 64) if h >= 1 << 63 else h

    return max(range(shards), key=lambda s: (hashed(s), s))


def test_sharding_query_equals_brute_force(spark, tmp_path):
    from membertide.llm import queries

    spark.createDataFrame([r[:2] for r in ROWS], "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op2_sharding(spark, str(tmp_path)).collect()
    got = sorted(key([r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard]) for r in rows)
    raw = lambda t: (t or "").encode()
    assert got == sorted(key([d, len(raw(t)) + 8, zlib.crc32(raw(t)), "key", brute_shard(d, 24), brute_shard(d, 25)]) for d, t, *_ in ROWS)
    assert all(brute_shard(d, 25) in (brute_shard(d, 24), 24) for d, *_ in ROWS)


@pytest.mark.parametrize("name", ["shard", "Bucket", "size", "slot", "place"])
def test_sharding_refuses_its_own_names(spark, tmp_path, name):
    with pytest.raises(ValueError, match=name):
        sharding.write_shards(spark.createDataFrame([(1, "a", 2)], f"doc_id bigint, text string, {name} int"), f"{tmp_path}/x")


def test_shards(spark, docs):
    path = Scratch(spark).path("shards")
    grown = sharding.shard_of(F.col("doc_id"), 6)
    sharding.write_shards(docs.select("doc_id", "text", grown.alias("grown")), path, shards=5)
    rows = sharding.read_shards(spark, path).collect()
    assert sorted(key([r.doc_id, r.text]) for r in rows) == sorted(key(r[:2]) for r in ROWS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.size == len((r.text or "").encode()) + 8
        assert r.grown in (r.shard, 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r.doc_id for r in rows})
    sharding.write_shards(docs.select("doc_id", "text").limit(0), path + "-none", shards=5)
    assert sharding.read_shards(spark, path + "-none").count() == 0


def test_sharding_splits_into_buckets_and_runs_no_python(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 1000)
    path = Scratch(spark).path("shards")
    sharding.write_shards(docs.select("doc_id", "text"), path, shards=2)
    assert spark.read.parquet(f"{path}/buckets").count() > 4
    read = sharding.read_shards(spark, path)
    assert sorted(r.slot for r in read.filter("shard = 1").collect()) == list(range(read.filter("shard = 1").count()))
    assert not any(w in read._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Pandas", "Arrow"))


# tokens


@pytest.fixture(scope="module")
def ids_of():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(ids_of):
    texts = [r[1] for r in ROWS] + ["I'm can't 'SHE'LL <|startoftext|>a", "Ünïcode ÀÉ ß² 12ab34 \u0301x e\u0301 \u2003 中文 👍🏽", "a\u00a0b\x1cc ,'s.", "İstanbul ΑΣ"]
    for end in (None, 2):
        found = encoder(default_tokenizer()).encode(texts, end)
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [ids_of(t) + [2] * bool(end) for t in texts]
        ids, bounds = encoder(default_tokenizer()).flat(pa.array(texts)[3:9], end)
        assert [ids[b:e].tolist() for b, e in zip(bounds, bounds[1:])] == [ids_of(t) + [2] * bool(end) for t in texts[3:9]]


def test_encoder_forgets_and_still_agrees(ids_of):
    from membertide.llm.tokens import WordEncoder

    small, rng = WordEncoder(default_tokenizer(), capacity=5), random.Random(1)
    for _ in range(30):
        text = " ".join(data.prose(rng, 9, 30))
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == ids_of(text)


def test_token_store_round_trip_and_lookup(spark, docs, ids_of, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_TOKENS", 700)
    path = Scratch(spark).path("store")
    token_store.write(docs, path)
    rows = token_store.with_start(token_store.read_all(spark, path), spark, path).collect()
    want = sorted(key([r[0], (ids_of(r[1]) + [2])]) for r in ROWS)
    assert sorted(key([r.doc_id, np.frombuffer(r.ids, "<u4").tolist()]) for r in rows) == want
    at = 0
    rows.sort(key=lambda r: r.start)
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d or 0))
    asked = spark.createDataFrame([(0,), (11,), (10**9,), (-4,), (None,), (11,)], "doc_id bigint")
    found = token_store.lookup(spark, path, asked).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in ROWS if r[0] in (0, 11))
    assert all(key([r.doc_id, np.frombuffer(r.ids, "<u4").tolist()]) in want for r in found)


def test_token_store_of_nothing(spark, docs):
    path = Scratch(spark).path("store")
    token_store.write(docs.limit(0), path)
    assert token_store.with_start(token_store.read_all(spark, path), spark, path).count() == 0
    assert token_store.lookup(spark, path, docs.select("doc_id")).count() == 0


def test_lookup_reads_the_shards_of_its_keys_and_exchanges_no_payload(spark, docs, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_TOKENS", 300)
    monkeypatch.setattr(token_store, "FILE_SHARDS", 1)
    path = Scratch(spark).path("store")
    token_store.write(docs, path)
    stored = spark.read.parquet(f"{path}/shards")
    assert stored.select("range").distinct().count() > 2
    found = token_store.lookup(spark, path, spark.createDataFrame([(20,)], "doc_id bigint"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    payload = next(line for line in plan.splitlines() if "FileScan" in line and "payload" in line)
    assert "range" in payload[payload.index("PartitionFilters") :] and "GreaterThanOrEqual(high,20)" in payload
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    texts = {r[1] for r in ROWS if r[0] == 20}
    assert found.count() == len([r for r in ROWS if r[0] == 20]) and texts


def test_many_keys_are_looked_up_too(spark, docs, ids_of, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_TOKENS", 300)
    monkeypatch.setattr(token_store, "NAMED", 2)
    path = Scratch(spark).path("store")
    token_store.write(docs, path)
    found = token_store.lookup(spark, path, docs.select("doc_id")).collect()
    want = [key([r[0], ids_of(r[1]) + [2]]) for r in ROWS if r[0] is not None]
    assert sorted(key([r.doc_id, np.frombuffer(r.ids, "<u4").tolist()]) for r in found) == sorted(want)


def test_rows_of_one_id_are_split_over_ranges(spark, ids_of):
    rows = [(7, f"word {i}") for i in range(400)] + [(None, "x")] * 50 + [(8, "y")]
    path = Scratch(spark).path("store")
    token_store.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), path)
    hot = spark.read.parquet(f"{path}/shards").filter("low = 7").select("range").distinct().count()
    assert hot > 1
    found = token_store.lookup(spark, path, spark.createDataFrame([(7,)], "doc_id bigint")).collect()
    assert Counter(r.ids for r in found) == Counter(np.array(ids_of(t) + [2], "<u4").tobytes() for i, t in rows if i == 7)


def test_token_store_query_has_the_checksums_of_its_ids(spark, sf_dir, ids_of):
    from membertide.llm import queries

    rows, start = {r.doc_id: r for r in queries.op9_token_store(spark, sf_dir).collect()}, 0
    for doc in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda d: d.doc_id):
        ids = np.array(ids_of(doc.text) + [2], "<u4")
        found = rows.pop(doc.doc_id)
        assert (found.start, found.n_tokens, found.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not rows


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 20_000).astype(np.uint64))
    slots = token_store.PerfectHash.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_packing(spark, docs, ids_of, monkeypatch):
    monkeypatch.setattr(packing, "POOL_TOKENS", 3000)
    pieces = packing.pieces_digest(packing.pack(docs.repartition(2))).collect()
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_sequence[p.sequence_id].append(p)
    for window in of_sequence.values():
        window.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in window]).tolist()
        assert [p.offset for p in window] == [0, *ends[:-1]]
        assert ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0
        assert len({(p.step_id, p.tier) for p in window}) == 1 and window[0].tier == ends[-1]
    for p in pieces:
        of_doc[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    for doc, text, *_ in {r[:2] + (0,) for r in ROWS if r[0] is not None and Counter(x[0] for x in ROWS)[r[0]] == 1}:
        ids, at = ids_of(text) + [1], 0
        for start, length, crc, total in sorted(of_doc[doc]):
            assert (start, total) == (at, len(ids))
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    assert sum(p.length for p in pieces) == sum(len(ids_of(r[1])) + 1 for r in ROWS)
    assert packing.pack(docs.limit(0)).count() == 0


def test_step_groups_are_even():
    rng = random.Random(8)
    windows = [(256, [(n, 0, 0), (256 - n, 1, 0)]) for n in (rng.randrange(1, 256) for _ in range(64))]
    groups = packing.step_groups(windows, 2048)
    assert set(Counter(groups).values()) == {8}
    costs = Counter()
    for g, (_, w) in zip(groups, windows):
        costs[g] += sum(p[0] ** 2 for p in w)
    assert max(costs.values()) < 1.1 * min(costs.values())


# token counts


def test_counts_follow_edits(spark, docs, ids_of):
    rng, edits = random.Random(4), []
    for doc, text, *_ in ROWS:
        for _ in range(rng.choice([0, 1, 4]) if doc is not None else 0):
            b = rng.randrange(len(text or "") + 2)
            edits.append((doc, b, b + rng.choice([0, 1, 5, 40]), rng.choice(["", " ", "zz", " new words ", "é", None])))
    state = token_counts.build(docs)
    edited = token_counts.update(token_counts.with_edits(state, spark.createDataFrame(edits, "doc_id bigint, begin int, end int, text string"))).collect()
    own = defaultdict(list)
    for doc, b, e, t in edits:
        own[doc].append({"begin": b, "end": e, "text": t})
    want = []
    for doc, text, *_ in ROWS:
        taken, done = [], 0
        for e in sorted(own[doc], key=lambda e: (e["begin"], e["end"], e["text"] is not None, e["text"])) if text is not None else ():
            if done <= e["begin"] and e["end"] <= len(text):
                taken.append(e)
                done = e["end"]
        new = text
        for e in reversed(taken):
            new = new[: e["begin"]] + (e["text"] or "") + new[e["end"] :]
        want.append(key([doc, new, len(ids_of(new)), len(taken), len(own[doc]) - len(taken)]))
    assert sorted(key([r.doc_id, r.text, r.n_tokens, r.n_edits, r.n_skipped]) for r in edited) == sorted(want)


def cleaned(text):
    """The text without lines that stood before, mail addresses and long numbers masked, and the number of edits."""
    seen, parts, edits = set(), [], 0
    lines = text.split("\n")
    for i, line in enumerate(lines):
        end = "\n" if i < len(lines) - 1 else ""
        if line.strip() and line in seen:
            edits += 1
            continue
        seen.add(line)
        places = [(m.start(), m.end(), "<mail>") for m in re.finditer(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", line)]
        places += [(m.start(), m.end(), "<number>") for m in re.finditer(r"\d([ .-]?\d){6,}", line)]
        out, done = "", 0
        for b, e, new in sorted(places):
            if b >= done:
                out, done, edits = out + line[done:b] + new, e, edits + 1
        parts.append(out + line[done:] + end)
    return "".join(parts), edits


def test_counts_query_equals_encoding_again(spark, tmp_path, ids_of):
    from membertide.llm import queries

    lines = ["write to a.b+c@x-y.example.org or call +49 170 1234567", "one line", "one line", "7 654 321 and 12.34.56.78.90", "é@a.b 1234567@x.yz", "", "", "  ", "end"]
    rows = [r[:2] for r in ROWS] + [(10**6 + i, "\n".join(lines[i:] + lines[:i])) for i in range(len(lines))] + [(10**7, "\n".join(lines * 3))]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op4_token_counts(spark, str(tmp_path)).collect()
    want = []
    for doc, text in rows:
        new, edits = cleaned(text or "")
        digest = None if text is None else hashlib.sha256(new.encode()).hexdigest()
        want.append(key([doc, len(ids_of(text)), edits if text is not None else 0, len(ids_of(new)), digest]))
    assert sorted(key([r.doc_id, r.n_tokens_before, r.n_edits, r.n_tokens, r.text_sha256]) for r in found) == sorted(want)
    assert any(r.n_edits > 3 for r in found) and all((r.n_encoded > 0) == (r.n_edits > 0) for r in found)


def test_counts_refuse_clashing_names_and_take_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 3)], "doc_id bigint, text string, n_tokens int")
    for run in (token_counts.build, lambda d: token_counts.build_and_update(d, token_counts.cleaning_edits)):
        with pytest.raises(ValueError, match="n_tokens"):
            run(docs)
    (row,) = token_counts.build(docs, prefix="t_").collect()
    assert (row.n_tokens, row.t_n_tokens) == (3, 2)
    with pytest.raises(ValueError, match="n_edits"):
        token_counts.update(token_counts.build(docs.drop("n_tokens")).selectExpr("*", "null AS edits", "1 AS n_edits"))
    assert token_counts.build_and_update(docs.drop("n_tokens").limit(0), token_counts.cleaning_edits).count() == 0


def test_an_edit_encodes_little(ids_of):
    count = encoder(default_tokenizer())
    raw = " ".join(data.prose(random.Random(1), 5000)).encode()
    tree = token_counts.TokenTree(raw, *token_counts.TokenTree.shape(raw, count.counts([raw])[0]), count.count)
    tree.edit(12_000, 12_003, b"other")
    assert tree.encoded <= 4
    assert int(tree.tokens[1]) == len(ids_of(tree.text().decode()))


# URLs


def brute_urls(urls):
    def split(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        return (data.ascii_lower(m[1]), m[2]) if m else ("", "")

    def rule(host, path):
        fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        return (best.name, best.verdict) if best else (None, None)

    return [(u, *split(u), *rule(*split(u))) for u in urls]


def test_urls_equal_brute_force(spark):
    rng = random.Random(6)
    hosts = ["a.net", "x.example.net", "example.net", "spam-farm.example.com", "b.example.com", "notexample.com", "c.org", "net", "anet"]
    urls = [None, "", "no scheme", "spam-farm.example.com/de/7", "http://", "HTTP://EXAMPLE.net/en/?q#f", "x://a.b://c.org/fr/", "http://a.net", "http://a.net?x/", "ü://É.net/ü"]
    tails = ["", "", "?buy=now", "?p=1#top", "#cheap"]
    urls += [f"https://{rng.choice(hosts)}/{rng.choice(['en', 'fr', 'de', 'EN'])}/{rng.randrange(40)}{rng.choice(tails)}" for _ in range(300)]
    urls += ["https://c.org/x/1" + t for t in tails]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, score string").repartition(3)
    scratch = Scratch(spark)
    found = {r.page_id: r for r in url_filter.judge(pages, scratch).collect()}
    brute = brute_urls(urls)
    for i, (_, host, path, name, verdict) in enumerate(brute):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, name)
    # the models, from scratch
    held = {r.v for r in spark.createDataFrame([(u,) for u in urls if u], "v string").distinct().filter(f"pmod(xxhash64(7, v), {url_filter.HELD_OUT}) = 0").collect()}
    distinct = {u: v for u, *_, v in brute if u}
    order, counts = url_filter.ORDER, {"allow": Counter(), "block": Counter()}
    grams = lambda s: [("\x02" * order + s + "\x03")[i : i + order + 1] for i in range(len(s) + 1)]
    for s, v in distinct.items():
        if v and s not in held:
            counts[v].update(grams(s))

    def chance(v, gram):
        p = url_filter.UNIFORM
        for k in range(order + 1):
            after = Counter()
            for g, c in counts[v].items():
                if g[order - k : order] == gram[order - k : order]:
                    after[g[-1]] += c
            n, t = sum(after.values()), len(after)
            p = (after[gram[-1]] + t * p) / (n + t) if n else p
        return p

    weight = {}
    for s in distinct:
        for g in grams(s):
            weight.setdefault(g, round((math.log(chance("allow", g)) - math.log(chance("block", g))) * 1e6))
    score = {u: sum(weight[g] for g in grams(u)) / (len(u) + 1) / 1e6 for u in distinct}
    for i, u in enumerate(urls):
        assert found[i].score is None if not u else abs(found[i].score - score[u]) < 2e-6
    # the threshold with the least balanced error on the held-out part, and the verdicts
    judged = [(math.floor(found[urls.index(u)].score * 1000), distinct[u]) for u in held if distinct[u]]
    good, bad = (sum(v == w for _, v in judged) for w in ("allow", "block"))
    assert good and bad
    error = lambda t: sum(v == "allow" and s < t for s, v in judged) / good + sum(v == "block" and s >= t for s, v in judged) / bad
    edges = sorted({s for s, _ in judged})
    least = min(edges, key=lambda t: (error(t), t))
    for i, (u, _, _, _, verdict) in enumerate(brute):
        assert found[i].verdict == (verdict or ("allow" if not u or found[i].score * 1000 >= least else "block"))
    method = {found[i].verdict for i, (u, _, _, _, verdict) in enumerate(brute) if u and not verdict}
    assert method == {"allow", "block"}
    assert len({found[i].score for i, u in enumerate(urls) if u and u.startswith("https://c.org/x/1")}) == 4
    assert url_filter.judge(pages.limit(0), scratch).count() == 0


def test_threshold_has_the_least_balanced_error(spark):
    scored = spark.createDataFrame([(0.5, "allow"), (0.3, "allow"), (-0.1, "allow"), (-0.2, "block"), (0.1, "block"), (-0.5, "block")], "score double, label string")
    assert url_filter.threshold(scored) in (-100, 300)
    assert url_filter.threshold(scored.filter("label = 'allow'")) == 0
