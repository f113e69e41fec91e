"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from gleanery.llm import decontamination, extraction, fingerprints, language, licenses, manifest, neardup, ngramjoin, packing, quality, toxicity, urls, whitening

QUERIES = {
    f.__name__: f
    for f in (
        quality.op1_quality_classifier,
        neardup.op2_minhash_near_dedup,
        extraction.op3_html_extraction,
        packing.op4_packing,
        fingerprints.op5_fingerprints,
        licenses.op6_license_scans,
        toxicity.op7_toxicity,
        language.op8_language_id,
        decontamination.op9_decontamination,
        urls.op10_url_filters,
        whitening.op11_embedding_whitening,
        ngramjoin.op12_ngram_jaccard_join,
        manifest.op13_merkle_manifest,
    )
}

ORACLES: dict[str, str] = {
    "op2_minhash_near_dedup": neardup.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op12_ngram_jaccard_join": ngramjoin.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}
