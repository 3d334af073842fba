"""The text operators' registered queries and their SQL."""

from __future__ import annotations

from . import chat_format, collocations, curriculum, exact_dedup, knn_quality, line_dedup, minhash, packing, quality_rules, source_divergence, substring_dedup, token_counts, warc

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_token_counts": token_counts.query,
    "op3_minhash_near_dedup": minhash.query,
    "op4_chat_format": chat_format.query,
    "op5_knn_quality": knn_quality.query,
    "op6_best_fit_packing": packing.query,
    "op7_warc": warc.query,
    "op8_quality_rules": quality_rules.query,
    "op9_curriculum_mix": curriculum.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_collocations": collocations.query,
    "op12_source_divergence": source_divergence.query,
    "op13_line_dedup": line_dedup.query,
}

#: The others rest on learned rules, token ids, hashed orders or streams of turns; tests compare
#: them with brute-force versions.
ORACLES = {
    "op7_warc": warc.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_source_divergence": source_divergence.ORACLE,
    "op13_line_dedup": line_dedup.ORACLE,
}
