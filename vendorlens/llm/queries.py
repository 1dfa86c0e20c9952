"""Queries of this package by name, and the SQL that some of them equal."""

from __future__ import annotations

from vendorlens.llm import (
    alignment, licenses, lines, mixing, neighbours, packing, prefixes, quality, simhash, substrings, suffixes, topk, urls)

QUERIES = {f.__name__: f for f in (
    suffixes.op1_suffix_array_dedup,
    lines.op2_line_dedup,
    substrings.op3_substring_dedup,
    simhash.op4_simhash_components,
    topk.op5_topk_inner_product,
    quality.op6_host_rules,
    licenses.op7_license_scan,
    packing.op8_pack_sequences,
    mixing.op9_curriculum_mix,
    urls.op10_url_filter,
    alignment.op11_token_alignment,
    neighbours.op12_adaptive_neighbours,
    prefixes.op13_conversation_trie,
)}
ORACLE_SQL = {
    "op5_topk_inner_product": topk.ORACLE,
    "op6_host_rules": quality.ORACLE,
    "op10_url_filter": urls.ORACLE,
    "op13_conversation_trie": prefixes.ORACLE,
}
