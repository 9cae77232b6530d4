"""The registered queries of the training-data operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from workpulse.llm import (bpe, decontaminate, hard_negatives, lang_id, license_scan, line_dedup, near_dedup, ngram_join, phrases, pii, quality_rules,
                           sharding, token_counts)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_jump_sharding": sharding.op2_jump_sharding,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_lang_id": lang_id.op4_lang_id,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_pii": pii.op7_pii,
    "op8_winnowing": decontaminate.op8_winnowing,
    "op5_license_scan": license_scan.op5_license_scan,
    "op9_bpe": bpe.op9_bpe,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_phrases": phrases.op12_phrases,
    "op13_near_dedup": near_dedup.op13_near_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op6_ngram_join": ngram_join.OP6_SQL,
    "op8_winnowing": decontaminate.OP8_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_phrases": phrases.OP12_SQL,
    "op13_near_dedup": near_dedup.OP13_SQL,
}
