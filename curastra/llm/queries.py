"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, language, licences, minhash, mixing, neighbours, pieces, privacy, quality, rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": minhash.query,
    "op2_quality_classifier": quality.query,
    "op3_sentencepiece": pieces.query,
    "op4_nearest_neighbours": neighbours.query,
    "op5_license_scan": licences.query,
    "op6_source_mix": mixing.query,
    "op7_pii": privacy.query,
    "op8_quality_rules": rules.query,
    "op9_chat_format": chat.query,
    "op10_language_id": language.query,
}
#: The others train models, search approximately, or read a vocabulary: tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": minhash.ORACLE,
    "op8_quality_rules": rules.ORACLE,
    "op9_chat_format": chat.ORACLE,
}
