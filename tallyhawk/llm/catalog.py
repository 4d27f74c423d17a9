"""Queries and SQL of the operators of this package."""

from __future__ import annotations

from tallyhawk.llm import (
    crf_quality, exact_dedup, langid, line_frequency, ngram_jaccard, periodic_runs, phrases, pii, poisson_mix, sentencepiece,
    site_template, threshold_topk, token_orc,
)

_MODULES = {
    "op1_site_template": site_template,
    "op2_crf_quality": crf_quality,
    "op3_pii": pii,
    "op4_threshold_topk": threshold_topk,
    "op5_line_frequency": line_frequency,
    "op6_unigram_langid": langid,
    "op7_poisson_mix": poisson_mix,
    "op8_ngram_jaccard": ngram_jaccard,
    "op9_sentencepiece": sentencepiece,
    "op10_exact_dedup": exact_dedup,
    "op11_periodic_runs": periodic_runs,
    "op12_token_orc": token_orc,
    "op13_phrases": phrases,
}

QUERIES = {name: module.query for name, module in _MODULES.items()}
ORACLE = {name: module.ORACLE_SQL for name, module in _MODULES.items() if getattr(module, "ORACLE_SQL", None)}
