"""Several sinks of one stream, written batch by batch, with a ledger of what went where.

One ``foreachBatch`` writes every part of a micro-batch into a folder of its own that carries the batch id, replacing whatever an
earlier attempt left there; so a batch that is handed over again changes nothing, whichever sink had been reached before. The ledger
has one row per batch, sink and reason, counted while the rows are written. Nothing of a batch is dropped: a part that no stream
goes on with is a sink like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.operators.contracts import normalize_documents
from pulseframe.operators.flatten import flatten_batches
from pulseframe.streaming.streams import run_batches, split_future

LEDGER = T.StructType().add("sink", "string").add("reason", "string").add("n", "long")
BATCH = "__batch"


@dataclass(frozen=True)
class Sinks:
    """Where a routed stream's parts lie."""

    folder: str

    def part(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        """All rows of a sink; an empty frame while no batch has come."""
        return _read(spark, f"{self.folder}/{name}", schema)

    def ledger(self, spark: SparkSession) -> DataFrame:
        """sink, reason and n per batch (``__batch``)."""
        return _read(spark, f"{self.folder}/ledger", T.StructType([*LEDGER, T.StructField(BATCH, T.LongType())]))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def write_batch(parts: dict[str, DataFrame], reasons: dict[str, list[str]], folder: str, batch: int) -> None:
    """Write one micro-batch's parts and its ledger rows; a repeated call with the same batch id leaves the same files' content.

    ``reasons`` lists the reasons that a sink's ``reason`` column may hold; a sink without any is counted as a whole.
    """
    rows = []
    for name, part in parts.items():
        known = reasons.get(name, [])
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("reason") == r).alias(r) for r in known]]
        part.observe(seen, *counts).write.mode("overwrite").parquet(f"{folder}/{name}/{BATCH}={batch}")
        got = seen.get
        rows += [(name, r, got[r]) for r in known if got[r]] if known else []
        rest = got["all"] - sum(got[r] for r in known)
        rows += [(name, None if not known else "other", rest)] if rest else []
    spark = next(iter(parts.values())).sparkSession
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{folder}/ledger/{BATCH}={batch}")


def route(stream: DataFrame, split: Callable[[DataFrame], dict[str, DataFrame]], folder: str, checkpoint: str,
          reasons: dict[str, list[str]] | None = None) -> Sinks:
    """Run a stream over all that has arrived and write each batch's ``split(batch)`` into sinks below ``folder``."""
    def handle(batch: DataFrame, number: int) -> None:
        write_batch(split(batch), reasons or {}, folder, number)

    run_batches(stream, handle, checkpoint)
    return Sinks(folder)


#: Why a document is refused. Fixed values.
REJECTED = ["invalid_document", "identity_mismatch"]


def split_samples(kind: str = "telemetry", unknown: str = "drop") -> Callable[[DataFrame], dict[str, DataFrame]]:
    """Batch documents into flat ``samples`` and ``quarantine`` (doc_id, kind, reason and the document)."""
    def split(batch: DataFrame) -> dict[str, DataFrame]:
        valid, refused = normalize_documents(batch, kind, unknown)
        return {"samples": flatten_batches(valid), "quarantine": refused}

    return split


def split_events(time: str = "detected_at", tolerance: str = "1 day", now: Column | None = None) -> Callable[[DataFrame], dict[str, DataFrame]]:
    """Events into ``kept`` and ``set_aside``, those of the future with their reason."""
    def split(batch: DataFrame) -> dict[str, DataFrame]:
        kept, late = split_future(batch, time, tolerance, now)
        return {"kept": kept, "set_aside": late.withColumn("reason", F.lit("from_the_future"))}

    return split
