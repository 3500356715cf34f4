"""The queries of this package, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm import audit, decontaminate, knn, language, lines, negatives, packing, pii, rules, secrets, simhash, suffix, toxicity

QUERIES = {
    "op1_semi_markov_pii": pii.query,
    "op2_grammar_toxicity": toxicity.query,
    "op3_simhash_near_dedup": simhash.query,
    "op4_qgram_decontamination": decontaminate.query,
    "op5_previous_factor_dedup": suffix.query,
    "op6_voronoi_top_k": knn.query,
    "op7_byte_network_language": language.query,
    "op8_set_join_lines": lines.query,
    "op9_forest_secret_scan": secrets.query,
    "op10_min_slack_packing": packing.query,
    "op11_slot_hard_negatives": negatives.query,
    "op12_quality_rules": rules.query,
    "op13_filter_audit": audit.query,
}

ORACLE_SQL = {"op6_voronoi_top_k": knn.ORACLE, "op11_slot_hard_negatives": negatives.ORACLE, "op13_filter_audit": audit.ORACLE}
