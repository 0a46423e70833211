"""The registered queries of this subpackage and their SQL, where SQL can say the same."""

from __future__ import annotations

from sigscore.llm import (collocations, language_id, mixing, near_dedup, neighbours, packing, prefix_trie,
                          quality_classifier, quality_rules, substring_dedup, suffix_dedup, toxicity,
                          url_filter)

QUERIES = {
    "op1_near_dedup": near_dedup.op1,
    "op2_quality_rules": quality_rules.op2,
    "op3_toxicity": toxicity.op3,
    "op4_mixing": mixing.op4,
    "op5_substring_dedup": substring_dedup.op5,
    "op6_quality_classifier": quality_classifier.op6,
    "op7_neighbours": neighbours.op7,
    "op8_language_id": language_id.op8,
    "op9_url_filter": url_filter.op9,
    "op10_packing": packing.op10,
    "op11_prefix_trie": prefix_trie.op11,
    "op12_suffix_dedup": suffix_dedup.op12,
    "op13_collocations": collocations.op13,
}
ORACLE = {
    "op1_near_dedup": near_dedup.OP1_SQL,
    "op5_substring_dedup": substring_dedup.OP5_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op13_collocations": collocations.OP13_SQL,
}


def queries() -> dict:
    import corpus_pipeline
    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
