"""Queries of the text operators: one ``opN_<name>`` each, over whole tables.

Some have results that SQL can express (``ORACLE``). For the others it cannot, or not in reasonable
time (learned models, span positions, zstandard, tokenizers, hashes that DuckDB lacks);
``tests/llm`` holds all of them against brute-force versions.
"""

from __future__ import annotations

from strata.llm import bpe, decontam, exact_dedup, merkle, near_dedup, oracles, pii, quality_model, quality_rules, secrets, sharding, toxicity, warc, whitening

QUERIES = {
    "op1_decontam": decontam.op1_decontam,
    "op2_sharding": sharding.op2_sharding,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_quality_model": quality_model.op4_quality_model,
    "op5_bpe": bpe.op5_bpe,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_secrets": secrets.op7_secrets,
    "op8_warc": warc.op8_warc,
    "op9_pii": pii.op9_pii,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_exact_dedup": exact_dedup.op11_exact_dedup,
    "op12_merkle": merkle.op12_merkle,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE: dict[str, str] = {"op1_decontam": oracles.DECONTAM, "op3_near_dedup": oracles.NEAR_DEDUP, "op8_warc": oracles.WARC,
                          "op11_exact_dedup": oracles.EXACT_DEDUP, "op12_merkle": oracles.MERKLE}
