"""The queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pagemill.llm import alignment, audit, bpe, brown, dedup, fingerprint, langid, licenses, neighbours, packing, quality, simhash, urls

QUERIES = {
    "op1_quality": quality.query,
    "op2_license_scan": licenses.query,
    "op3_best_fit": packing.query,
    "op4_order_minhash": dedup.query,
    "op5_language": langid.query,
    "op6_edit_fingerprint": fingerprint.query,
    "op7_brown_lm": brown.query,
    "op8_url_rules": urls.query,
    "op9_collision_counting": neighbours.query,
    "op10_bpe": bpe.query,
    "op11_alignment": alignment.query,
    "op12_filter_audit": audit.query,
    "op13_simhash": simhash.query,
}

ORACLES: dict[str, str] = {
    "op8_url_rules": urls.SQL,
    "op12_filter_audit": audit.SQL,
}
