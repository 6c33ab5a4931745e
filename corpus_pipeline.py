"""A training corpus from documents: reject bad texts, keep one of each near-duplicate group, mask personal data, mix
sources to target weights, encode. Every stage takes and, but for the last, returns the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curastra.llm import minhash, mixing, pieces, privacy, quality
from curastra.llm.common import Scratch, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it learns from ``labels`` of the documents that are there."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 or more on five-word shingles."""
    return minhash.keep_one(docs, words=5, num=80, den=100)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return privacy.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the pieces of its text with its N best paths and the decode check, and slot and place in the mixture: files
    keep no order, so that it is data."""
    placed = mixing.place(docs.select("doc_id", "source", "text")).select("row.doc_id", "row.text", "slot", "place")
    return pieces.encode(placed, keep=("slot", "place"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("minhash_near_dedup", near_dedup),
    ("pii", mask_personal_data),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

#: Trained models and hashed orders have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return docs
