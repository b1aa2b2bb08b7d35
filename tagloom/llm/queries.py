"""Queries and SQL of the text operators, for the entry point."""

from . import chat, decontaminate, language, minhash, mixing, ppm, quality, suffix, token_counts, token_output

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_token_output": token_output.op2_token_output,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_minhash_near_dedup": minhash.op4_minhash_near_dedup,
    "op5_language_id": language.op5_language_id,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_preference_chat": chat.op7_preference_chat,
    "op8_lm_scoring": ppm.op8_lm_scoring,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_suffix_dedup": suffix.op10_suffix_dedup,
}
ORACLE_SQL = {
    "op1_mixing": mixing.OP1_SQL,
    "op4_minhash_near_dedup": minhash.OP4_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op7_preference_chat": chat.OP7_SQL,
}
