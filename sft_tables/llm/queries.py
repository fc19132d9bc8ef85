"""The operators' queries and their SQL, by name."""

from __future__ import annotations

from sft_tables.llm import (
    exact_dedup, fingerprints, importance, katz, langid, mixing, near_dedup, pieces, repeats, token_counts, toxicity, warc, whitening,
)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_mix_sources": mixing.query,
    "op3_fingerprints": fingerprints.query,
    "op4_sentencepiece": pieces.query,
    "op5_lm_score": katz.query,
    "op6_warc": warc.query,
    "op7_repeats": repeats.query,
    "op8_language_id": langid.query,
    "op9_near_dedup": near_dedup.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_token_counts": token_counts.query,
    "op12_importance": importance.query,
    "op13_whitening": whitening.query,
}

ORACLES = {
    "op2_mix_sources": mixing.SQL,
    "op6_warc": warc.SQL,
    "op7_repeats": repeats.SQL,
    "op9_near_dedup": near_dedup.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op12_importance": importance.SQL,
}
