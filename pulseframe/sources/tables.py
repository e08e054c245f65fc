"""Flat tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.functions.columns import array_mean, finite_or_null
from pulseframe.schemas import SAMPLES

READ_FORMATS = ("csv", "parquet")
WRITE_FORMATS = ("csv", "parquet", "json")


def format_of(path: str) -> str:
    """Table format from the path's suffix."""
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()


def read_samples(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Flat samples with the declared schema; NaN becomes NULL. Arrays in CSV are JSON text."""
    fmt = fmt or format_of(path)
    if fmt not in READ_FORMATS:
        raise ValueError(f"cannot read samples from '{fmt}'; use one of {', '.join(READ_FORMATS)}")
    if fmt == "parquet":
        return finite_or_null(spark.read.schema(SAMPLES).parquet(path))
    text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType)
                         for f in SAMPLES.fields])
    df = spark.read.schema(text).option("header", True).csv(path)
    df = df.withColumn("ibi_ms", F.from_json("ibi_ms", T.ArrayType(T.DoubleType())))
    return finite_or_null(df)


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> None:
    """Export; nested columns become JSON text in CSV."""
    fmt = fmt or format_of(path)
    if fmt not in WRITE_FORMATS:
        raise ValueError(f"cannot write '{fmt}'; use one of {', '.join(WRITE_FORMATS)}")
    if fmt == "csv":
        nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
        df = df.withColumns({n: F.to_json(n) for n in nested}) if nested else df
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def save_dataset(wide: DataFrame, exclusions: DataFrame, path: str) -> None:
    """Persist the labelled dataset (by split when it has one) and its exclusion ledger."""
    writer = wide.write.mode("overwrite")
    if "split" in wide.columns:
        writer = writer.partitionBy("split")
    writer.parquet(f"{path}/dataset")
    exclusions.write.mode("overwrite").parquet(f"{path}/exclusions")


def load_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/dataset"), spark.read.parquet(f"{path}/exclusions")


def ibi_summary(samples: DataFrame) -> DataFrame:
    """Exploration view: IBI count and mean per sample instead of the array; the mean of none is null."""
    values = F.coalesce("ibi_ms", F.array().cast("array<double>"))
    return samples.select(
        "batch_id", "user_id", "device_id", "session_id", "sequence", "timestamp", "heart_rate_bpm",
        F.size(values).cast("bigint").alias("ibi_count"), array_mean(values).alias("ibi_mean_ms"),
        "skin_temperature_celsius", "quality_heart_rate", "quality_ibi")
