"""Registered queries of this folder and their DuckDB SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from sylva.llm import (
    conversation_repair,
    decontamination,
    jaccard_join,
    licenses,
    mixing,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    tokens,
    toxicity,
    vector_codes,
    warc,
)

QUERIES = {
    "op1_decontaminate": decontamination.op1_decontaminate,
    "op2_shard_minimax": sharding.op2_shard_minimax,
    "op3_token_files": tokens.op3_token_files,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_quality_classifier": quality_classifier.op10_quality_classifier,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_repair_conversations": conversation_repair.op12_repair_conversations,
    "op13_warc": warc.op13_warc,
}

ORACLES = {
    "op5_jaccard_join": jaccard_join.ORACLE,
    "op6_mix_sources": mixing.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op12_repair_conversations": conversation_repair.ORACLE,
    "op13_warc": warc.ORACLE,
}
