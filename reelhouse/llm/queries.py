"""Registered queries of the operators: one ``opN_`` name each."""

from __future__ import annotations

from reelhouse.llm import (
    chat_format, decontaminate, exact_dedup, html_text, importance, language_id,
    lm_score, minhash_dedup, mixing, prefix_trie, sharding, suffix_dedup, token_counts,
)

QUERIES = {
    "op1_preference_format": chat_format.query,
    "op2_digest_index": exact_dedup.query,
    "op3_elias_fano_lm": lm_score.query,
    "op4_histogram_sort": sharding.query,
    "op5_bbit_minhash": minhash_dedup.query,
    "op6_token_counts": token_counts.query,
    "op7_language_id": language_id.query,
    "op8_source_mix": mixing.query,
    "op9_template_decontamination": decontaminate.query,
    "op10_suffix_dedup": suffix_dedup.query,
    "op11_importance_resampling": importance.query,
    "op12_html_text": html_text.query,
    "op13_prefix_trie": prefix_trie.query,
}

ORACLE = {"op1_preference_format": chat_format.SQL, "op2_digest_index": exact_dedup.SQL}
