"""The queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import importlib

# Module and function of each query; the name of the function is the query's.
QUERIES = {
    "op1_toxicity": "toxicity",
    "op2_minimax_shards": "sharding",
    "op4_url_filters": "url_filters",
    "op3_ngram_join": "ngram_join",
    "op5_piece_samples": "sentence_pieces",
    "op6_nra_top_k": "top_k",
    "op7_substring_dedup": "substring_dedup",
    "op8_embedding_dedup": "embedding_dedup",
    "op9_line_runs": "line_dedup",
    "op10_packing": "packing",
    "op11_conversation_repair": "conversation_repair",
    "op12_importance_resample": "importance",
    "op13_run_length_index": "run_length_index",
}


def queries() -> dict:
    found = {name: getattr(importlib.import_module(f".{module}", __package__), name) for name, module in QUERIES.items()}
    return found


def oracle_sql() -> dict[str, str]:
    from . import importance, top_k, url_filters

    return {
        "op4_url_filters": url_filters.ORACLE, "op6_nra_top_k": top_k.ORACLE,
        "op12_importance_resample": importance.ORACLE,
    }
