"""Queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tideguard.llm import decontamination, language_model, merkle_manifest, mixing, periodic_runs, personal_data, projection_forest, quality_classifier, quality_rules, setsketch, substring_dedup, token_files, toxicity

QUERIES = {
    "op2_substring_dedup": substring_dedup.query,
    "op4_lm_scoring": language_model.query,
    "op3_toxicity": toxicity.query,
    "op9_personal_data": personal_data.query,
    "op1_quality_rules": quality_rules.query,
    "op8_quality_classifier": quality_classifier.query,
    "op10_minhash_near_dedup": setsketch.query,
    "op7_benchmark_decontamination": decontamination.query,
    "op5_source_mixing": mixing.query,
    "op6_token_files": token_files.query,
    "op11_merkle_manifest": merkle_manifest.query,
    "op12_periodic_runs": periodic_runs.query,
    "op13_embedding_near_dedup": projection_forest.query,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op11_merkle_manifest": merkle_manifest.ORACLE,
}
