"""The registered queries of this package: name -> (query, oracle SQL or None)."""

from __future__ import annotations

from govlens.llm import alignment, decontam, langid, lines, merkle, packing, pages, pieces, quality, secrets, simhash, vectors, warc

REGISTRY = {
    "op1_line_dedup": (lines.op1, lines.ORACLE),
    "op2_best_fit_packing": (packing.op2, None),
    "op3_embedding_near_dedup": (vectors.op3, vectors.ORACLE),
    "op4_simhash_near_dedup": (simhash.op4, None),
    "op5_html_extraction": (pages.op5, None),
    "op6_warc_archive": (warc.op6, warc.ORACLE),
    "op7_language_id": (langid.op7, None),
    "op8_secret_scan": (secrets.op8, secrets.oracle()),
    "op9_benchmark_decontamination": (decontam.op9, None),
    "op10_quality_classifier": (quality.op10, None),
    "op11_merkle_manifest": (merkle.op11, merkle.ORACLE),
    "op12_sentencepiece": (pieces.op12, None),
    "op13_tokenizer_alignment": (alignment.op13, None),
}
