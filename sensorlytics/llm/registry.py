"""Queries and oracles of this folder, for ``__spark_entry__.py``."""

from sensorlytics.llm import (bpe, conversation_repair, exact_dedup, fingerprints, line_dedup, ngram_join, packing, pitman_yor,
                              quality_classifier, quality_rules, token_alignment, toxicity, url_filter)

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_quality_classifier": quality_classifier.op4_quality_classifier,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_pitman_yor": pitman_yor.op6_pitman_yor,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}
ORACLES = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op7_ngram_join": ngram_join.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op12_conversation_repair": conversation_repair.ORACLE,
}
