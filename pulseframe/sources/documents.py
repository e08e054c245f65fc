"""Raw documents, one JSON document per line, kept as text so that key spellings can be resolved later."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Microseconds are kept; the default JSON format would cut times to milliseconds.
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
KINDS = ("telemetry", "suspected", "decision", "request")


def _checked(kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"unknown document kind '{kind}'; use one of {', '.join(KINDS)}")
    return kind


def read_documents(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One row per document: ``value`` (text) and ``kind``. Nothing is parsed or inferred here."""
    return spark.read.text(path).filter(F.trim("value") != "").withColumn("kind", F.lit(_checked(kind)))


def stream_documents(spark: SparkSession, path: str, kind: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream over files arriving in a folder."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).filter(F.trim("value") != "").withColumn("kind", F.lit(_checked(kind)))


def write_documents(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Structured documents back to one JSON document per line."""
    documents.select(F.to_json(F.struct("*"), JSON_TIME).alias("value")).write.mode(mode).text(path)
