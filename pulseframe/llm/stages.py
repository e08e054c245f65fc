"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame, all but the last with the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from pulseframe.llm.common import small_batches, table

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents at hand and keep those that are not predicted toxic."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score_toxicity(docs, model).filter("predicted = 0").select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove later occurrences of three-line windows; n_chars follows the text that stays."""
    small_batches(spark)
    out = line_dedup.remove_repeated_windows(docs)
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near duplicates (five words, similarity 0.8): the one with the smallest doc_id.

    Texts are compared by row: a row with a null doc_id, or with a doc_id that another text has too, takes part under a number of
    its own, behind the others; rows that repeat doc_id and text are one document and one of them stays.
    """
    small_batches(spark)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64("text").alias("sig"))
    several = rows.filter("id IS NOT NULL").groupBy("id").agg(F.min("sig").alias("least"), F.max("sig").alias("most")).filter("least <> most")
    rows = rows.join(several, "id", "left")
    apart = F.col("id").isNull() | (F.col("sig") != F.coalesce("least", "sig"))
    # From 2^62 upwards.
    number = F.shiftrightunsigned(F.xxhash64("id", "sig", F.xxhash64(F.lit(1), "text")), 2).bitwiseOR(F.lit(1 << 62))
    rows = rows.select("row", "text", F.when(apart, number).otherwise(F.col("id")).alias("node"))
    groups = ngram_join.jaccard_components(rows, ngram_join.JoinParams(n=5, percent=80), id_col="node").withColumnRenamed("doc_id", "node")
    rest = groups.filter("node <> component_id").select("node").distinct()
    repeated = groups.groupBy("node").count().filter("count > 1").select("node")
    kept = rows.join(rest, "node", "left_anti")
    # Only repeated rows are brought together; the smallest of them stays, whatever the other columns hold.
    once = kept.join(repeated, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row"))
    return kept.join(repeated, "node", "left_anti").select("row").unionByName(once.select("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    small_batches(spark)
    out = bpe.encode_decode(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), results=("ids", "ids_sha256", "decoded_sha256"))
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")
