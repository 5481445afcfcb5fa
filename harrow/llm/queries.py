"""The numbered queries and the SQL of those that SQL can express."""

from harrow.llm import (
    bpe,
    embedding_dedup,
    html_extract,
    importance_sample,
    license_scan,
    line_dedup,
    minhash_dedup,
    preference_format,
    quality_rules,
    source_audit,
    source_mix,
    token_counts,
    toxicity,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_minhash_dedup": minhash_dedup.op4_minhash_dedup,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_source_mix": source_mix.op6_source_mix,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_html_extract": html_extract.op8_html_extract,
    "op9_preference_format": preference_format.op9_preference_format,
    "op10_byte_bpe": bpe.op10_byte_bpe,
    "op11_source_audit": source_audit.op11_source_audit,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_importance_sample": importance_sample.op13_importance_sample,
}

ORACLES = {
    "op1_line_dedup": line_dedup.SQL,
    "op2_embedding_dedup": embedding_dedup.SQL,
    "op4_minhash_dedup": minhash_dedup.SQL,
    "op5_license_scan": license_scan.SQL,
    "op6_source_mix": source_mix.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op9_preference_format": preference_format.SQL,
    "op11_source_audit": source_audit.SQL,
    "op13_importance_sample": importance_sample.SQL,
}
