"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snaptrack.llm import (
    chunks,
    conversations,
    jaccard,
    language_model,
    licenses,
    lines,
    negatives,
    packing,
    pieces,
    quality_model,
    quality_rules,
    sharding,
    topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": lines.op1,
    "op2_quality_model": quality_model.op2,
    "op3_pieces": pieces.op3,
    "op4_sharding": sharding.op4,
    "op5_packing": packing.op5,
    "op6_pivot_topk": topk.op6,
    "op7_quality_rules": quality_rules.op7,
    "op8_ngram_jaccard": jaccard.op8,
    "op9_chunk_dedup": chunks.op9,
    "op10_license_scan": licenses.op10,
    "op11_hard_negatives": negatives.op11,
    "op12_conversation_repair": conversations.op12,
    "op13_language_model": language_model.op13,
}

ORACLES: dict[str, str] = {
    "op6_pivot_topk": topk.ORACLE,
    "op7_quality_rules": quality_rules.oracle(),
    "op8_ngram_jaccard": jaccard.ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
    "op12_conversation_repair": conversations.ORACLE,
}
