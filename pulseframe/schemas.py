"""Declared schemas of documents and tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Enum domains and size limits of the telemetry contract.
SIGNAL_QUALITY = ("good", "fair", "poor", "unknown")
WEARING_STATE = ("onBody", "offBody", "unknown")
MAX_SAMPLES = 600
MAX_IBI = 16

QUALITY = T.StructType([
    T.StructField("heart_rate", T.StringType()),
    T.StructField("ibi", T.StringType()),
    T.StructField("wearing_state", T.StringType()),
])

ACCELEROMETER = T.StructType([T.StructField(axis, T.DoubleType()) for axis in "xyz"])

SAMPLE = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("heart_rate_bpm", T.DoubleType()),
    T.StructField("ibi_ms", T.ArrayType(T.DoubleType())),
    T.StructField("accelerometer", ACCELEROMETER),
    T.StructField("skin_temperature_celsius", T.DoubleType()),
    T.StructField("ambient_temperature_celsius", T.DoubleType()),
    T.StructField("quality", QUALITY),
])

TELEMETRY = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("samples", T.ArrayType(SAMPLE)),
])

SNAPSHOT = T.StructType([
    T.StructField("heart_rate_mean", T.DoubleType()),
    T.StructField("heart_rate_max", T.DoubleType()),
    T.StructField("heart_rate_slope_bpm_per_minute", T.DoubleType()),
    T.StructField("heart_rate_delta_from_baseline", T.DoubleType()),
    T.StructField("rmssd_millis", T.DoubleType()),
    T.StructField("sdnn_millis", T.DoubleType()),
    T.StructField("movement_magnitude_mean", T.DoubleType()),
    T.StructField("movement_variance", T.DoubleType()),
    T.StructField("valid_sample_ratio", T.DoubleType()),
    T.StructField("last_sample_age_seconds", T.LongType()),
    T.StructField("sample_count", T.LongType()),
])

BASELINE = T.StructType([
    T.StructField("sample_count", T.LongType()),
    T.StructField("mean_heart_rate", T.DoubleType()),
    T.StructField("heart_rate_m2", T.DoubleType()),
    T.StructField("updated_at_epoch_millis", T.LongType()),
])

SUSPECTED = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("detected_at", T.TimestampType()),
    T.StructField("state", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("rules_version", T.StringType()),
    T.StructField("features", SNAPSHOT),
    T.StructField("baseline", BASELINE),
])

DECISION = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("detected_at", T.TimestampType()),
    T.StructField("responded_at", T.TimestampType()),
    T.StructField("response", T.StringType()),
])

# One scoring request: raw samples around one detector event.
REQUEST = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("detected_at", T.TimestampType()),
    T.StructField("samples", T.ArrayType(SAMPLE)),
])

# Flat samples: the central table, one row per sample. ``pos`` is the place inside its document.
SAMPLES = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("heart_rate_bpm", T.DoubleType()),
    T.StructField("ibi_ms", T.ArrayType(T.DoubleType())),
    T.StructField("skin_temperature_celsius", T.DoubleType()),
    T.StructField("quality_heart_rate", T.StringType()),
    T.StructField("quality_ibi", T.StringType()),
    T.StructField("quality_wearing_state", T.StringType()),
])

EXCLUSIONS = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# Time order of samples, with ties broken the same way everywhere.
SAMPLE_ORDER = ("timestamp", "sequence", "pos")

# Fixed value: the feature order every saved model and scoring table uses.
FEATURE_SCHEMA = (
    "hr_mean", "hr_std", "hr_min", "hr_max", "hr_slope_bpm_per_min",
    "hrv_rmssd", "hrv_sdnn", "ibi_available", "ibi_coverage_ratio", "skin_temp_mean",
    "quality_good_ratio", "quality_fair_ratio", "quality_poor_ratio", "valid_sample_ratio",
    "window_duration_seconds", "sample_count",
)

# Fixed value: identity and detector columns that may never reach a model.
FORBIDDEN_FEATURES = (
    "detector_score", "detector_state", "rules_version", "response",
    "user_id", "session_id", "device_id", "event_id",
)
