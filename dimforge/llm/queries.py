"""Queries and oracle SQL of this package, by key."""

from __future__ import annotations

from dimforge.llm import (
    bpe,
    decontamination,
    html_extraction,
    lexical_search,
    lm_scoring,
    quality_classifier,
    quality_rules,
    simhash,
    substring_dedup,
    suffix_dedup,
    url_reputation,
    warc,
    whitening,
)

QUERIES = {
    "op1_lm_scoring": lm_scoring.op1_lm_scoring,
    "op2_html_extraction": html_extraction.op2_html_extraction,
    "op3_benchmark_decontamination": decontamination.op3_benchmark_decontamination,
    "op4_url_filters": url_reputation.op4_url_filters,
    "op5_suffix_array_dedup": suffix_dedup.op5_suffix_array_dedup,
    "op6_simhash_near_dedup": simhash.op6_simhash_near_dedup,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_bpe": bpe.op8_bpe,
    "op9_quality_classifier": quality_classifier.op9_quality_classifier,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_warc": warc.op12_warc,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

#: Those that SQL can express; the others are tested against brute force.
ORACLE = {
    "op2_html_extraction": html_extraction.ORACLE_SQL,
    "op3_benchmark_decontamination": decontamination.ORACLE_SQL,
    "op4_url_filters": url_reputation.ORACLE_SQL,
    "op7_quality_rules": quality_rules.ORACLE_SQL,
    "op11_lexical_search": lexical_search.ORACLE_SQL,
    "op12_warc": warc.ORACLE_SQL,
}
