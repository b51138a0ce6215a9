"""Queries of the training-text operators, by name, and their SQL."""

from __future__ import annotations

from permaway.llm import decontaminate, fuzzylines, licenses, linehash, mixing, ngramjoin, quality, suffixdedup, topk, toxicity

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_quality": quality.op2_quality,
    "op3_suffix_dedup": suffixdedup.op3_suffix_dedup,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_ngram_jaccard": ngramjoin.op5_ngram_jaccard,
    "op6_exact_top_k": topk.op6_exact_top_k,
    "op7_fuzzy_lines": fuzzylines.op7_fuzzy_lines,
    "op8_line_hash_dedup": linehash.op8_line_hash_dedup,
    "op9_mix": mixing.op9_mix,
    "op10_toxicity": toxicity.op10_toxicity,
}
SQL = {
    "op1_license_scan": licenses.SQL,
    "op4_decontaminate": decontaminate.SQL,
    "op6_exact_top_k": topk.SQL,
    "op8_line_hash_dedup": linehash.SQL,
    "op9_mix": mixing.SQL,
}
