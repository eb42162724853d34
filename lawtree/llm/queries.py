"""Registered queries of the language-model operators and their SQL counterparts."""

from lawtree.llm import (
    bytecnn, credentials, embeddup, lattice, licenses, linedup, merkle, mixing, pieces, resampling, simhash, topk, toxicity,
)

QUERIES = {
    "op1_exact_top_k": topk.op1_exact_top_k,
    "op2_lattice_score": lattice.op2_lattice_score,
    "op3_quality_classifier": bytecnn.op3_quality_classifier,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_line_dedup": linedup.op7_line_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_embedding_near_dedup": embeddup.op10_embedding_near_dedup,
    "op11_secret_scan": credentials.op11_secret_scan,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_target_resampling": resampling.op13_target_resampling,
}

ORACLES = {
    "op1_exact_top_k": topk.ORACLE,
    "op4_license_scan": licenses.ORACLE,
    "op7_line_dedup": linedup.ORACLE,
    "op10_embedding_near_dedup": embeddup.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_target_resampling": resampling.ORACLE,
}
