"""Structured Streaming forms of the same semantics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulseframe.functions.columns import finite_or_null, ibi_summary_struct, micros
from pulseframe.operators.classifiers import predict
from pulseframe.operators.contracts import normalize_documents
from pulseframe.operators.features import feature_columns
from pulseframe.operators.flatten import flatten_batches
from pulseframe.operators.windows import event_gate_reason
from pulseframe.params import EventWindowParams, FeatureToggles, WindowParams
from pulseframe.sources.documents import stream_documents
from pulseframe.sources.models import SavedModel

# HRV links neighbouring samples in time order, which a stream sees only after the watermark; the batch
# operators compute it. These stay null in epoch-aligned streaming windows.
ORDERED_FEATURES = ("hrv_rmssd", "hrv_sdnn", "hrv_pnn50")


def stream_samples(spark: SparkSession, path: str, delay: str = "10 minutes", unknown: str = "drop",
                   files_per_trigger: int | None = None) -> DataFrame:
    """Batch documents arriving as files: normalised, flattened, with a watermark on sample time."""
    raw = stream_documents(spark, path, "telemetry", files_per_trigger)
    valid, _ = normalize_documents(raw, "telemetry", unknown)
    return flatten_batches(valid).withWatermark("timestamp", delay)


def split_future(events: DataFrame, time: str = "detected_at", tolerance: str = "1 day", now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(plausible rows, rows from the future), to be used before a watermark is set.

    One row of a watch whose clock runs ahead would move the watermark past everything that follows. Rows later than
    ``now`` (the time of the micro-batch unless given) by more than ``tolerance`` are set aside for a sink of their own.
    """
    late = F.coalesce(F.col(time) > (F.current_timestamp() if now is None else now) + F.expr(f"INTERVAL {tolerance}"), F.lit(False))
    return events.filter(~late), events.filter(late)


def dedup_events_stream(events: DataFrame, delay: str = "10 minutes", time: str = "detected_at", tolerance: str = "1 day",
                        now: Column | None = None) -> DataFrame:
    """Each event id once within the watermark horizon; rows from the future are left out (see :func:`split_future`)."""
    plausible, _ = split_future(events, time, tolerance, now)
    return plausible.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_id"])


def event_windows_stream(samples: DataFrame, events: DataFrame, params: EventWindowParams = EventWindowParams(),
                         how: str = "inner") -> DataFrame:
    """Samples joined to events of the same session and device with T - size <= time <= T.

    Both sides need a watermark (``timestamp``, ``detected_at``). "inner" adds the time bucket to the key, so
    state is probed per bucket. "left_outer" keeps events without samples once the watermark passes T.
    """
    size = micros(params.size_seconds)
    interval = f"INTERVAL {size} MICROSECONDS"
    e = events.select("event_id", F.col("session_id").alias("e_session"), F.col("device_id").alias("e_device"),
                      F.col("user_id").alias("e_user"), "detected_at")
    s = samples
    key = (F.col("session_id") == F.col("e_session")) & (F.col("device_id") == F.col("e_device"))
    if how == "inner":
        at = F.unix_micros("detected_at")
        e = e.withColumn("e_bucket", F.explode(F.sequence(F.floor((at - size) / F.lit(size)), F.floor(at / F.lit(size)))))
        s = s.withColumn("__bucket", F.floor(F.unix_micros("timestamp") / F.lit(size)))
        key = key & (F.col("__bucket") == F.col("e_bucket"))
    inside = F.expr(f"timestamp >= detected_at - {interval} AND timestamp <= detected_at")
    user = F.col("e_user").isNull() | (F.col("e_user") == F.col("user_id"))
    return e.join(s, key & inside & user, how).drop("e_bucket", "__bucket", "session_id", "device_id").withColumnsRenamed(
        {"e_session": "session_id", "e_device": "device_id"}).drop("e_user")


def event_gate_stream(samples: DataFrame, events: DataFrame, params: EventWindowParams = EventWindowParams()) -> DataFrame:
    """Every event once with its row count, share of heart rates and gate reason (null when the window is usable), in append mode.

    The stream form of :func:`pulseframe.operators.windows.event_window_gate`; both sides need a watermark. A left-outer join by time
    bucket is followed by a count per event, so a session's state is split over its buckets and events without a sample come out
    as ``missing_telemetry``. An event is final once the watermark has passed it by the window size.
    """
    size = micros(params.size_seconds)
    at, span = F.unix_micros("detected_at"), F.lit(size)
    e = events.select("event_id", "session_id", "device_id", "user_id", "detected_at",
                      F.explode(F.sequence(F.floor((at - size) / span), F.floor(at / span))).alias("bucket"))
    s = samples.select(F.col("session_id").alias("s_session"), F.col("device_id").alias("s_device"), F.col("user_id").alias("s_user"),
                       "timestamp", F.col("heart_rate_bpm").isNotNull().alias("has_hr"),
                       F.floor(F.unix_micros("timestamp") / span).alias("s_bucket"))
    near = F.expr(f"timestamp >= detected_at - INTERVAL {size} MICROSECONDS AND timestamp <= detected_at")
    same = (F.col("session_id") == F.col("s_session")) & (F.col("device_id") == F.col("s_device")) & (F.col("bucket") == F.col("s_bucket"))
    user = F.col("user_id").isNull() | (F.col("user_id") == F.col("s_user"))
    # Only one event time may reach the count: that of the event. has_hr is null exactly where no sample was found.
    joined = e.join(s, same & near & user, "left_outer").drop("timestamp", "bucket", "s_session", "s_device", "s_user", "s_bucket")
    got = joined.groupBy("event_id", "session_id", "device_id", "user_id", "detected_at").agg(
        F.count("has_hr").alias("n_samples"), F.count_if("has_hr").alias("n_hr"))
    got = got.withColumn("hr_ratio", F.when(F.col("n_samples") > 0, F.col("n_hr") / F.col("n_samples"))).drop("n_hr")
    return got.withColumn("reason", event_gate_reason(F.col("n_samples"), F.col("hr_ratio"), params))


def sliding_features_stream(samples: DataFrame, params: WindowParams = WindowParams(),
                            toggles: FeatureToggles = FeatureToggles()) -> DataFrame:
    """Window features over epoch-aligned sliding windows, final once the watermark passes the window end.

    Differs from the batch operator in two stated ways: windows start at multiples of the stride instead of
    the session's first sample, and samples are not filled (that needs their order).
    """
    size, stride = (f"{micros(s)} microseconds" for s in (params.size_seconds, params.stride_seconds))
    rows = samples.withColumns({"ibi": ibi_summary_struct("ibi_ms"), "w": F.window("timestamp", size, stride),
                                "ibi_prev": F.lit(None).cast("struct<value:double,at:timestamp>")})
    rows = rows.withColumn("window_start", F.col("w.start"))
    chosen = [n for n in toggles.names() if n not in ORDERED_FEATURES]
    kept = FeatureToggles(**{n: n in chosen for n in FeatureToggles.all_on().names()})
    got = rows.groupBy("w", "session_id").agg(F.count(F.lit(1)).alias("n_samples"),
                                              (F.count("heart_rate_bpm") / F.count(F.lit(1))).alias("hr_ratio"), *feature_columns(kept))
    got = got.filter((F.col("n_samples") >= params.min_samples) & (F.col("hr_ratio") >= params.min_hr_ratio))
    named = got.withColumns({n: F.lit(None).cast("double") for n in toggles.names() if n in ORDERED_FEATURES})
    return finite_or_null(named.select("session_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                                       "n_samples", *toggles.names()))


def score_stream(features: DataFrame, model: SavedModel, key: str = "session_id") -> DataFrame:
    """Probability and thresholded prediction on a stream of feature rows."""
    scored = predict(features, model.classifier, key)
    return scored.withColumns({"prediction": (F.col("probability") >= F.lit(model.threshold)).cast("int"),
                               "model_version": F.lit(model.model_version), "target": F.lit(model.target)})


def link_decisions_stream(events: DataFrame, decisions: DataFrame, horizon_seconds: float) -> DataFrame:
    """Detector events with the response that arrives within the horizon; null when none does.

    Both sides need a watermark (``detected_at``, ``responded_at``). Unanswered events appear once the
    watermark passes their horizon.
    """
    d = decisions.select(F.col("event_id").alias("d_event"), "responded_at", "response")
    horizon = f"INTERVAL {micros(horizon_seconds)} MICROSECONDS"
    within = F.expr(f"responded_at >= detected_at AND responded_at <= detected_at + {horizon}")
    return events.join(d, (F.col("event_id") == F.col("d_event")) & within, "left_outer").drop("d_event")


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that a finished query dropped because they came behind the watermark; zero means that nothing is missing."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for progress in query.recentProgress for op in progress["stateOperators"])


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that has arrived, into parquet files, and stop."""
    query = (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand each micro-batch to ``handle(df, batch_id)``; make it idempotent in the batch id."""
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
