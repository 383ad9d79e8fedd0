"""The corpus pipeline: documents through the stages, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snaptrack.llm import chunks, jaccard, lines, packing, quality_rules
from snaptrack.llm.tables import stored, table


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.passing(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line makes redundant."""
    return lines.without_repeats(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five words and a similarity of 0.8 connect."""
    return jaccard.one_of_each(docs, size=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds."""
    return chunks.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and steps."""
    return packing.pack(docs, packing.tokenizer_path(), packing.tokenizer_path(packing.RANKS))


STAGES = [
    ("quality rules", keep_by_rules),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("substring dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

# Edit distance, content-defined chunks and byte-pair tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
