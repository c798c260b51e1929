"""The queries of this package and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from tickloom.llm import (
    cover_tree,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    mixing,
    pair_counts,
    permutation_index,
    quality_classifier,
    quality_rules,
    secrets,
    token_orc,
    unigram,
)

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_permutation_index": permutation_index.op3_permutation_index,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_sentencepiece": unigram.op5_sentencepiece,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_licenses": licenses.op7_licenses,
    "op8_language_id": language_id.op8_language_id,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_mixing": mixing.op10_mixing,
    "op11_token_orc": token_orc.op11_token_orc,
    "op12_cover_tree": cover_tree.op12_cover_tree,
    "op13_pair_counts": pair_counts.op13_pair_counts,
}
ORACLE = {
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op9_jaccard_join": jaccard_join.OP9_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op12_cover_tree": cover_tree.OP12_SQL,
}
