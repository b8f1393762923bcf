"""Queries of the subpackage and the SQL twins of those that SQL can express."""

from __future__ import annotations

from . import chat, forest, language, licenses, lm, neardup, packing, personal, repair, substrings, topk, viterbi, whitening

QUERIES = {
    "op1_language_id": language.query,
    "op2_best_fit_packing": packing.query,
    "op3_forest_neighbours": forest.query,
    "op4_lm_scoring": lm.query,
    "op5_suffix_dedup": substrings.query,
    "op6_piece_encoding": viterbi.query,
    "op7_minhash_neardup": neardup.query,
    "op8_exact_topk": topk.query,
    "op9_chat_formatting": chat.query,
    "op10_license_scan": licenses.query,
    "op11_personal_data": personal.query,
    "op12_structure_repair": repair.query,
    "op13_embedding_whitening": whitening.query,
}

SQL: dict[str, str] = {
    "op8_exact_topk": topk.SQL,
    "op9_chat_formatting": chat.SQL,
    "op10_license_scan": licenses.SQL,
    "op12_structure_repair": repair.SQL,
}
