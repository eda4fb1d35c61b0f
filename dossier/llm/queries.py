"""The queries of this folder and their DuckDB twins (where SQL can say them)."""

from __future__ import annotations

from dossier.llm import (bpe, chat, chosen_path, exact_dedup, filter_audit, hard_negatives, language, mixing, ngram_join,
                         quality_rules, sharding, suffix_dedup, token_store)

QUERIES = {
    "op1_token_store": token_store.op1_token_store,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_chat": chat.op5_chat,
    "op6_bpe": bpe.op6_bpe,
    "op7_mixing": mixing.op7_mixing,
    "op8_sharding": sharding.op8_sharding,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_language_id": language.op10_language_id,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_minhash_paths": chosen_path.op12_minhash_paths,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE_SQL = {
    "op2_quality_rules": quality_rules.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op5_chat": chat.SQL,
    "op7_mixing": mixing.SQL,
    "op11_filter_audit": filter_audit.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
