"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from leadloom.llm import chat, exact_dedup, hard_negatives, html_text, language_id, ngram_join, packing, quality, sentence_pieces, simhash, spelling, token_count, toxicity

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_chat_format": chat.op2_chat_format,
    "op3_html_text": html_text.op3_html_text,
    "op4_language_id": language_id.op4_language_id,
    "op5_simhash": simhash.op5_simhash,
    "op6_packing": packing.op6_packing,
    "op7_token_counts": token_count.op7_token_counts,
    "op8_sentence_pieces": sentence_pieces.op8_sentence_pieces,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_ngram_join": ngram_join.op11_ngram_join,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLES = {
    "op2_chat_format": chat.ORACLE,
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op11_ngram_join": ngram_join.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
