"""The operators' registered queries and their SQL."""

from __future__ import annotations

from reelcat.llm import align, chat, exact_dedup, language, line_dedup, mixing, ngram_join, periodic, pieces, pii, quality, suffix_dedup, warc

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_personal_data": pii.op2_personal_data,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_language_id": language.op5_language_id,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_warc": warc.op7_warc,
    "op8_mixing": mixing.op8_mixing,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_sentencepiece": pieces.op10_sentencepiece,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_cross_tokenizer_alignment": align.op13_cross_tokenizer_alignment,
}
ORACLES = {
    "op1_chat_formatting": chat.ORACLE,
    "op3_quality_rules": quality.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op7_warc": warc.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
}
