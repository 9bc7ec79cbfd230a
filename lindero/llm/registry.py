"""Queries of this subpackage, and the SQL of those that SQL can express."""

from . import cotraining, graph_search, line_dedup, ngram_join, packing, quality_rules, secret_scan, sentencepiece_codec, token_files, url_filters

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_sentencepiece": sentencepiece_codec.op2_sentencepiece,
    "op3_packing": packing.op3_packing,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_token_files": token_files.op5_token_files,
    "op6_quality_classifier": cotraining.op6_quality_classifier,
    "op7_nearest": graph_search.op7_nearest,
    "op8_url_filters": url_filters.op8_url_filters,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_line_dedup": line_dedup.op10_line_dedup,
}


def oracles() -> dict[str, str]:
    return {"op4_quality_rules": quality_rules.ORACLE, "op8_url_filters": url_filters.oracle(), "op9_ngram_join": ngram_join.ORACLE, "op10_line_dedup": line_dedup.ORACLE}
