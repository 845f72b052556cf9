"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing, piece ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; ``run`` writes
each result as Parquet in the shared folder and reads it back as the next one's
``docs``. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lowtide.llm import line_dedup, mixing, ngram_join, repetition, sentencepiece
from lowtide.llm.queries import PIECES
from lowtide.sources.sinks import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or repeat themselves go."""
    return repetition.keep_clean(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, exactly or nearly, go; documents without a line left go too."""
    return line_dedup.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id."""
    return ngram_join.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the mix asks, none to three times."""
    return mixing.repeat(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``docs``, the piece ids of the text, and the text decoded from them in the place of ``text``."""
    return sentencepiece.recode(docs, PIECES)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_deduplication), ("ngram_join", near_duplicates),
          ("mixing", source_mix), ("sentencepiece", piece_ids)]

#: mixing and the piece lattice iterate, so there is no SQL for the whole run; tests hold it against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
