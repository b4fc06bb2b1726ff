"""Registered queries of the operators on training text."""

from __future__ import annotations

from callweave.llm import (
    bpe, conversation_repair, decontaminate, embedding_dedup, language_id, line_dedup, lm_score,
    near_dedup, passages, quality, secret_scan, spelling, toxicity,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality": quality.op2_quality,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_secrets": secret_scan.op4_secrets,
    "op5_lm_score": lm_score.op5_lm_score,
    "op6_passages": passages.op6_passages,
    "op7_bpe": bpe.op7_bpe,
    "op8_language": language_id.op8_language,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_conversations": conversation_repair.op11_conversations,
    "op12_spelling": spelling.op12_spelling,
    "op13_embedding_dedup": embedding_dedup.op13_embedding_dedup,
}
ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op2_quality": quality.OP2_SQL,
    "op11_conversations": conversation_repair.OP11_SQL,
    "op12_spelling": spelling.OP12_SQL,
    "op13_embedding_dedup": embedding_dedup.OP13_SQL,
}
