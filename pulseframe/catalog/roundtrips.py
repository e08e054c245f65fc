"""Sources and sinks: what is written comes back the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe import fixtures as fx
from pulseframe.catalog.base import SAMPLES, TRUTH, Query, kinds
from pulseframe.catalog.labelling import stored
from pulseframe.catalog.telemetry import telemetry_documents, uuid_sql
from pulseframe.operators import contracts, flatten
from pulseframe.schemas import FEATURE_SCHEMA
from pulseframe.schemas import SAMPLES as SAMPLES_SCHEMA
from pulseframe.sources import documents, tables

_FLAT = kinds(s="batch_id user_id device_id session_id quality_heart_rate quality_ibi", i="sequence", t="timestamp", d="heart_rate_bpm skin_temperature_celsius")


def _samples(fmt):
    def run(spark, sf_dir):
        path = f"{fx.scratch(spark)}/samples.{fmt}"
        # Times in text formats have milliseconds.
        tables.write_table(fx.samples(spark, sf_dir).withColumn("timestamp", F.date_trunc("second", "timestamp")), path)
        return tables.read_samples(spark, path).withColumn("n_ibi", F.size("ibi_ms"))

    return run


def _documents(spark, sf_dir):
    path = fx.scratch(spark)
    telemetry_documents(spark, sf_dir).write.text(path)
    valid, _ = contracts.normalize_documents(documents.read_documents(spark, path, "telemetry"), "telemetry")
    return flatten.flatten_batches(valid)


def _dataset(spark, sf_dir):
    path, made = fx.scratch(spark), stored(spark, sf_dir)
    tables.save_dataset(made.dataset, made.exclusions, path)
    dataset, exclusions = tables.load_dataset(spark, path)
    values = [F.col(c).cast("double").alias(c) for c in FEATURE_SCHEMA]
    none = [F.lit(None).cast("double").alias(c) for c in FEATURE_SCHEMA]
    return (dataset.select(F.lit("dataset").alias("part"), F.col("event_id").alias("key"), F.col("response_category").alias("label"), *values)
            .unionByName(exclusions.select(F.lit("exclusions").alias("part"), F.concat_ws(":", "kind", "doc_id").alias("key"), F.col("reason").alias("label"), *none)))


def _json(spark, sf_dir):
    path = f"{fx.scratch(spark)}/samples.json"
    tables.write_table(fx.samples(spark, sf_dir).withColumn("timestamp", F.date_trunc("second", "timestamp")), path)
    return spark.read.schema(SAMPLES_SCHEMA).json(path).withColumn("n_ibi", F.size("ibi_ms"))


_SAMPLES_SQL = f"WITH {SAMPLES} SELECT *, date_trunc('second', tm) AS \"timestamp\", len(ibi_ms) AS n_ibi FROM samples"

QUERIES = [
    *[Query(f"samples_{fmt}_round_trip", _samples(fmt), _FLAT | kinds(i="n_ibi"), _SAMPLES_SQL) for fmt in ("csv", "parquet")],
    Query("documents_round_trip", _documents, _FLAT,
          f"""WITH {SAMPLES} SELECT {uuid_sql('b', 'batch_id')} AS batch_id, {uuid_sql('u', 'user_id')} AS user_id, {uuid_sql('d', 'device_id')} AS device_id,
  {uuid_sql('s', 'session_id')} AS session_id, quality_heart_rate, quality_ibi, sequence, tm AS "timestamp", heart_rate_bpm, skin_temperature_celsius
  FROM samples WHERE CAST(session_id AS BIGINT) % 10 <> 0"""),
    Query("samples_json_round_trip", _json, _FLAT | kinds(i="n_ibi"), _SAMPLES_SQL),
    Query("dataset_round_trip", _dataset, kinds(s="part key label", d=" ".join(FEATURE_SCHEMA)),
          f"WITH {TRUTH} SELECT 'dataset' AS part, event_id AS key, response_category AS label, {', '.join(FEATURE_SCHEMA)} FROM ds "
          f"UNION ALL SELECT 'exclusions', kind || ':' || doc_id, reason, {', '.join('NULL' for _ in FEATURE_SCHEMA)} FROM ledger"),
]
