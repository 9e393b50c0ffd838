"""Thin queries over the operators, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from membertide.llm import (
    decontaminate,
    line_dedup,
    merkle,
    ngram_join,
    packing,
    parse_dedup,
    prefix_trie,
    repetition,
    sharding,
    substring_dedup,
    token_counts,
    token_store,
    url_filter,
)
from membertide.llm.common import Scratch, ship

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ngram_join.join_components(docs, Scratch(spark))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = Scratch(spark).path("shards")
    grown = sharding.shard_of(F.col("doc_id"), 25)
    sharding.write_shards(docs.withColumn("grown_shard", grown), path, shards=24)
    return sharding.read_shards(spark, path).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.dedup_substrings(docs, Scratch(spark))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    edited = token_counts.build_and_update(docs, token_counts.cleaning_edits)
    return edited.select("doc_id", "n_tokens_before", "n_edits", "n_encoded", "n_tokens", F.sha2("text", 256).alias("text_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, Scratch(spark), removed="n_removed")
    return kept.select(
        "doc_id",
        (F.size(F.split("text", "\n")) + F.col("n_removed")).alias("n_lines"),
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), Scratch(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_hits(docs, _table(spark, sf_dir, "benchmark"))
    return found.withColumn("n_hit", decontaminate.hit_count("spans")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path("token_store")
    token_store.write(_table(spark, sf_dir, "documents"), path)
    digest = token_store.read_all(spark, path).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
    return token_store.with_start(digest, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces_digest(packing.pack(_table(spark, sf_dir, "documents")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = _table(spark, sf_dir, "documents"), Scratch(spark)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = docs.select("doc_id", "lang", merkle.leaf(fields).alias("leaf"), *fields[1:2], "n_chars", "text")
    changed = F.when(tampered, merkle.leaf(fields))
    leaves = leaves.withColumn("n_chars", F.when(tampered, F.col("n_chars") + 1)).select("doc_id", "lang", "leaf", changed.alias("changed"))
    found = merkle.fold(merkle.build(leaves, scratch, replaced="changed"), scratch)
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    whole = scratch.table(prefix_trie.conversations(_table(spark, sf_dir, "conversations")), "conversations")
    base = F.col("conv_id") - F.col("conv_id") % 100
    length = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    found = prefix_trie.trie(prefix_trie.with_heads(whole, base, length, longest=5), scratch)
    return found.withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})


def op13_parse_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = parse_dedup.dedup_bytes(docs, Scratch(spark))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_sharding": op2_sharding,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_token_counts": op4_token_counts,
        "op5_line_dedup": op5_line_dedup,
        "op6_repetition": op6_repetition,
        "op7_url_filter": op7_url_filter,
        "op8_decontamination": op8_decontamination,
        "op9_token_store": op9_token_store,
        "op10_packing": op10_packing,
        "op11_merkle": op11_merkle,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_parse_dedup": op13_parse_dedup,
        "pipeline": corpus_pipeline.run,
    }


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
pairs AS (
  SELECT x.doc_id a, y.doc_id b, count(*) c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 90 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id a, doc_id b FROM n UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT n_shingles, coalesce(m.c, d.doc_id) component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) c FROM reach GROUP BY 1) m ON m.a = d.doc_id
"""

_OP3 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents
), windows AS (
  SELECT doc_id, i, hash(array_to_string(w[i:i + 12], ' ')) h, md5(array_to_string(w[i:i + 12], ' ')) m
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) i FROM d WHERE len(w) >= 13)
), later AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h, m) first FROM windows) WHERE first < doc_id
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) p FROM later),
words AS (SELECT doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) t, count(*) n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT n_words, (len(w) - coalesce(n, 0))::BIGINT n_removed, sha256(coalesce(t, '')) kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_RULES = repetition.Rules()

_OP6 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents
), windows AS (
  SELECT doc_id, n, i, hash(array_to_string(w[i:i + n - 1], ' ')) h1, md5(array_to_string(w[i:i + n - 1], ' ')) h
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) i
        FROM d, (VALUES (8), ({_RULES.min_repeat}), ({_RULES.longest_repeat + 1})) AS v(n) WHERE len(w) > n)
), twice AS (
  SELECT doc_id, n, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, n, h1, h) c FROM windows) WHERE c > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) FILTER (n = 8) n8, count(DISTINCT p) FILTER (n = {_RULES.min_repeat}) covered,
         bool_or(n = {_RULES.longest_repeat + 1}) too_long
  FROM (SELECT doc_id, n, unnest(range(i, i + n)) p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), base AS (
  SELECT d.doc_id, len(w)::BIGINT n_words, length(array_to_string(w, ''))::BIGINT word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols, coalesce(l.n, 0)::BIGINT n_dup_lines,
         coalesce(r.n8, 0)::BIGINT n_repeat_words, coalesce(r.covered, 0) covered, coalesce(r.too_long, false) too_long
  FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND 100 * covered <= {_RULES.covered_percent} * n_words AND NOT too_long AS kept
FROM base
"""

_OP8 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') win
  FROM (SELECT item_id, w, least(len(w), 13) n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) i FROM b WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) i
        FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (SELECT doc_id, n, i, item_id FROM doc_windows JOIN item_windows USING (n, win)),
places AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) p FROM hits) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) n_items, string_agg(s, ',' ORDER BY s) ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) s FROM hits) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit, coalesce(n_items, 0)::BIGINT n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""


#: crc32 by its bits, over the ASCII characters of ``s``; ``crc_table`` is one row.
_CRC_TABLE = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) crcs
)"""


def _crc32(s: str) -> str:
    codes = f"list_prepend(4294967295, list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _digest(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


_OP11 = f"""
WITH RECURSIVE {_CRC_TABLE}, docs AS (
  SELECT doc_id, coalesce('=' || lang, '') key, {_digest("n_chars")} leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_digest("(n_chars + 1)")} ELSE {_digest("n_chars")} END changed
  FROM documents, crc_table
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 pos, count(*) OVER (PARTITION BY key) total FROM docs
), trees AS (
  SELECT key, 0 lvl, pos, total, leaf h FROM leaves
  UNION ALL
  SELECT key, lvl + 1, pos // 2, (total + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM trees WHERE total > 1
  GROUP BY key, lvl, pos // 2, total
), subroots AS (
  SELECT key, h, row_number() OVER (ORDER BY key) - 1 pos, count(*) OVER () total FROM trees WHERE total = 1
), crown AS (
  SELECT 0 lvl, pos, total, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (total + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM crown WHERE total > 1 GROUP BY lvl, pos // 2, total
), folded AS (
  SELECT doc_id, key, leaf, 0 lvl, pos, total, changed h, '' proof FROM leaves
  UNION ALL
  SELECT doc_id, f.key, leaf, f.lvl + 1, f.pos // 2, (f.total + 1) // 2,
         sha256(CASE WHEN f.pos % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), proof || coalesce(s.h, '')
  FROM folded f LEFT JOIN trees s ON s.key = f.key AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1::BIGINT) WHERE f.total > 1
), upper_part AS (
  SELECT doc_id, leaf, s.h subroot, 0 lvl, s.pos, s.total, f.h, proof FROM folded f JOIN subroots s USING (key) WHERE f.total = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, u.lvl + 1, u.pos // 2, (u.total + 1) // 2,
         sha256(CASE WHEN u.pos % 2 = 1 THEN s.h || u.h ELSE u.h || coalesce(s.h, '') END), proof || coalesce(s.h, '')
  FROM upper_part u LEFT JOIN crown s ON s.lvl = u.lvl AND s.pos = xor(u.pos, 1::BIGINT) WHERE u.total > 1
)
SELECT doc_id, leaf, subroot, c.h root, sha256(proof) proof_sha256, u.h folded_root, u.h = c.h verified
FROM upper_part u, crown c WHERE u.total = 1 AND c.total = 1
"""


_OP12 = f"""
WITH {_CRC_TABLE.strip()}, whole AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), asked AS (SELECT whole.*, ({_crc32("conv_id::VARCHAR")} % 6)::BIGINT h FROM whole, crc_table),
rebuilt AS (
  SELECT a.conv_id c, list_concat(coalesce(b.l[1:a.h], []), a.l[a.h + 1:]) l
  FROM asked a LEFT JOIN whole b ON b.conv_id = a.conv_id - a.conv_id % 100
), prefixes AS (
  SELECT c, len(l) n, d, l[d].t t, sha256(l[1:d]::VARCHAR) k, sha256(l[1:d - 1]::VARCHAR) parent
  FROM (SELECT c, l, unnest(range(0, len(l) + 1)) d FROM rebuilt)
), nodes AS (
  SELECT k, d, any_value(parent) parent, min(c) conv_id, count(*) n_convs, any_value(length(t)) size,
         string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) ends
  FROM prefixes GROUP BY k, d
), children AS (SELECT parent k, d - 1 d, count(*) n FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n, 0) n_children FROM nodes LEFT JOIN children USING (k, d)),
below AS (
  SELECT u.k, u.d, count(*) FILTER (v.n_children = 0) n_leaves, sum((v.n_convs - 1) * coalesce(v.size, 0))::BIGINT saved_tokens
  FROM (SELECT DISTINCT x.k, x.d, y.k k2, y.d d2 FROM prefixes x JOIN prefixes y ON x.c = y.c AND x.d <= y.d) u
  JOIN counted v ON v.k = u.k2 AND v.d = u.d2 GROUP BY u.k, u.d
)
SELECT m.conv_id, m.d depth, p.conv_id parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens,
       sha256(coalesce(m.ends, '')) ends_sha256
FROM counted m JOIN below USING (k, d) LEFT JOIN nodes p ON p.k = m.parent AND p.d = m.d - 1
"""


_OP13 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) x FROM documents),
windows AS (
  SELECT doc_id, i, hash(s) h, md5(s) m
  FROM (SELECT doc_id, i, substr(x, 2 * i + 1, 200) s FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) i FROM d WHERE len(x) >= 200))
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h, m ORDER BY doc_id, i) n FROM windows) WHERE n > 1
), marked AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) span
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END fresh FROM later)
), spans AS (SELECT doc_id, min(i) b, max(i) + 100 e FROM marked GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) done, row_number() OVER (PARTITION BY doc_id ORDER BY b DESC) last
  FROM spans
), kept AS (
  SELECT doc_id, count(*) n_spans, sum(e - b)::BIGINT n_removed,
         string_agg(substr(x, 2 * done + 1, 2 * (b - done)) || CASE WHEN last = 1 THEN substr(x, 2 * e + 1) ELSE '' END, '' ORDER BY b) k
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(x) // 2)::BIGINT n_bytes, coalesce(n_removed, 0)::BIGINT n_removed, coalesce(n_spans, 0)::BIGINT n_spans,
       sha256(unhex(coalesce(k, x))) kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": _OP1,
        "op3_substring_dedup": _OP3,
        "op6_repetition": _OP6,
        "op8_decontamination": _OP8,
        "op11_merkle": _OP11,
        "op12_prefix_trie": _OP12,
        "op13_parse_dedup": _OP13,
    }
