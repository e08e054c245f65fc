"""Between nested documents and flat samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.schemas import SAMPLES


def _sample_columns(s: str) -> list[Column]:
    return [
        F.col(f"{s}.timestamp").alias("timestamp"),
        F.col(f"{s}.heart_rate_bpm").alias("heart_rate_bpm"),
        F.col(f"{s}.ibi_ms").alias("ibi_ms"),
        F.col(f"{s}.skin_temperature_celsius").alias("skin_temperature_celsius"),
        F.col(f"{s}.quality.heart_rate").alias("quality_heart_rate"),
        F.col(f"{s}.quality.ibi").alias("quality_ibi"),
        F.col(f"{s}.quality.wearing_state").alias("quality_wearing_state"),
    ]


def flatten_batches(batches: DataFrame) -> DataFrame:
    """One row per sample with its batch context; ``pos`` is the place in the document."""
    exploded = batches.select("batch_id", "user_id", "device_id", "session_id", "sequence",
                              F.posexplode("samples").alias("pos", "s"))
    return exploded.select("batch_id", "user_id", "device_id", "session_id", "sequence",
                           F.col("pos").cast("bigint").alias("pos"), *_sample_columns("s"))


def flatten_samples(requests: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The same columns from scoring requests, plus the event id and ``carry`` columns; no batch, sequence 0."""
    exploded = requests.select("event_id", *carry, "user_id", "device_id", "session_id", F.posexplode("samples").alias("pos", "s"))
    return exploded.select(
        "event_id", *carry, F.lit(None).cast("string").alias("batch_id"), "user_id", "device_id", "session_id",
        F.lit(0).cast("bigint").alias("sequence"), F.col("pos").cast("bigint").alias("pos"), *_sample_columns("s"))


def unflatten(samples: DataFrame) -> DataFrame:
    """Nested batch documents from flat samples, one per batch id, in document order.

    A batch is bounded by what one device sends at once; one over the contract's limit stays whole, so that the checks see it.
    """
    nested = F.struct(
        F.col("pos"),
        F.col("timestamp"), F.col("heart_rate_bpm"), F.col("ibi_ms"),
        F.lit(None).cast("struct<x:double,y:double,z:double>").alias("accelerometer"),
        F.col("skin_temperature_celsius"), F.lit(None).cast("double").alias("ambient_temperature_celsius"),
        F.struct(F.col("quality_heart_rate").alias("heart_rate"), F.col("quality_ibi").alias("ibi"),
                 F.col("quality_wearing_state").alias("wearing_state")).alias("quality"))
    grouped = samples.groupBy("batch_id").agg(
        F.min("user_id").alias("user_id"), F.min("device_id").alias("device_id"),
        F.min("session_id").alias("session_id"), F.min("sequence").alias("sequence"),
        F.min("timestamp").alias("started_at"), F.max("timestamp").alias("ended_at"),
        F.array_sort(F.collect_list(nested)).alias("s"))
    names = [f.name for f in SAMPLES.fields]
    assert set(names) <= set(samples.columns), "flat samples expected"
    return grouped.select(
        "batch_id", "device_id", "user_id", "session_id", "started_at", "ended_at", "sequence",
        F.transform("s", lambda x: x.dropFields("pos")).alias("samples"))
