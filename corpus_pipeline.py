"""Corpus pipeline: the stages that turn raw documents into encoded training text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulseframe.llm import stages
from pulseframe.llm.common import stored, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("line_dedup", stages.remove_repeated_lines),
    ("ngram_jaccard_join", stages.keep_one_of_each_group),
    ("benchmark_decontamination", stages.drop_contaminated),
    ("bpe", stages.encode),
]

# Classifier, components and encoding have no SQL form; tests/llm compares each stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
