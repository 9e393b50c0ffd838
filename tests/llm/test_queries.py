"""The registered queries on a whole small scale factor, and against SQL where there is any."""

from __future__ import annotations

import pytest
from compare import connect, difference

from membertide.llm import queries

WANTED = {
    "op1_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op2_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op3_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op4_token_counts": ["doc_id", "n_tokens_before", "n_edits", "n_encoded", "n_tokens", "text_sha256"],
    "op5_line_dedup": ["doc_id", "n_lines", "n_removed", "kept_sha256"],
    "op6_repetition": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op7_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op8_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op11_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_prefix_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13_parse_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_id"],
}


@pytest.mark.parametrize("name", WANTED)
def test_query(spark, sf_dir, name):
    found = queries.queries()[name](spark, sf_dir)
    assert found.columns == WANTED[name]
    if name in queries.oracle_sql():
        assert difference(found, connect(sf_dir), queries.oracle_sql()[name]) is None
    else:
        table = "pages" if name.startswith("op7") else "documents"
        rows, ids = found.collect(), spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
        assert len({r[0] for r in rows}) == ids
