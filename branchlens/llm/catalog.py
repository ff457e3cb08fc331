"""The numbered operators as queries, with DuckDB SQL where it can express them."""

from __future__ import annotations

from branchlens.llm import (
    bpe,
    decontam,
    fill_middle,
    fingerprints,
    jaccard,
    language,
    licenses,
    line_dedup,
    quality,
    sentencepieces,
    token_counts,
    warc,
    whitening,
)

QUERIES = {
    f.__name__: f
    for f in (
        token_counts.op1_token_counts,
        language.op2_language_id,
        decontam.op3_decontam,
        warc.op4_warc,
        jaccard.op5_jaccard_join,
        sentencepieces.op6_sentencepiece,
        fingerprints.op7_fingerprints,
        line_dedup.op8_line_dedup,
        licenses.op9_license_scan,
        quality.op10_quality_classifier,
        bpe.op11_byte_bpe,
        whitening.op12_whitening,
        fill_middle.op13_fill_in_middle,
        decontam.op3_proximity,
    )
}

ORACLE = {
    "op3_decontam": decontam.SQL,
    "op4_warc": warc.SQL,
    "op5_jaccard_join": jaccard.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op13_fill_in_middle": fill_middle.SQL,
}
