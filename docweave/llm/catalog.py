"""The registered queries of this subpackage and their oracles."""

from __future__ import annotations

from docweave.llm import (
    alignment,
    byte_bpe,
    cap_filters,
    decontaminate,
    fingerprints,
    language_id,
    minhash_forest,
    pii,
    quality,
    token_files,
    url_filters,
    warc,
    whitening,
)

QUERIES = {
    "op1_token_files": token_files.q_op1,
    "op2_language_id": language_id.q_op2,
    "op3_pii": pii.q_op3,
    "op4_warc": warc.q_op4,
    "op5_quality": quality.q_op5,
    "op6_byte_bpe": byte_bpe.q_op6,
    "op7_cap_filters": cap_filters.q_op7,
    "op8_decontaminate": decontaminate.q_op8,
    "op9_url_filters": url_filters.q_op9,
    "op10_minhash_forest": minhash_forest.q_op10,
    "op11_fingerprints": fingerprints.q_op11,
    "op12_whitening": whitening.q_op12,
    "op13_alignment": alignment.q_op13,
}

ORACLES = {
    "op9_url_filters": url_filters.ORACLE_SQL,
}
