"""Sliding, session and event-anchored windows with their gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.columns import micros
from pulseframe.functions.scale import HotKeys, broadcast_if_small, hot_keys, join_same, split_hot
from pulseframe.params import EventWindowParams, ScaleParams, WindowParams
from pulseframe.schemas import SAMPLE_ORDER

# The session's first user and device ride along as keys: they depend on the session alone, and keeping them
# out of the aggregates lets the window aggregation stay a hash aggregation.
SLIDING_KEYS = ("session_id", "window_index", "window_start", "window_end", "session_user_id", "session_device_id")


def session_bounds(df: DataFrame, scale: ScaleParams = ScaleParams(),
                   hot: HotKeys | str | None = "detect") -> DataFrame:
    """Add first and last time, row count, and first user and device of each session to its samples.

    Ordinary sessions: window functions on the partitioning cleaning already made, so no further exchange.
    Hot sessions: a pre-aggregated table with one row per hot session, joined back.
    """
    if hot == "detect":
        hot = hot_keys(df, ["session_id"], scale)
    order = F.struct(*SAMPLE_ORDER)

    def with_windows(d: DataFrame) -> DataFrame:
        running = Window.partitionBy("session_id").orderBy(*SAMPLE_ORDER)
        whole = running.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return d.withColumns({
            "session_start": F.min("timestamp").over(whole),
            "session_end": F.max("timestamp").over(whole),
            "session_rows": F.count(F.lit(1)).over(whole),
            "session_user_id": F.first("user_id").over(whole),
            "session_device_id": F.first("device_id").over(whole),
        })

    if hot is None:
        return with_windows(df)
    cold, rest = split_hot(df, ["session_id"], hot, scale)
    bounds = rest.groupBy("session_id").agg(
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("session_rows"),
        F.min_by("user_id", order).alias("session_user_id"), F.min_by("device_id", order).alias("session_device_id"))
    rest = join_same(rest, broadcast_if_small(bounds, hot.keys, scale), ["session_id"])
    cold = with_windows(cold)
    return cold.unionByName(rest.select(*cold.columns))


def _at(micros_col: Column) -> Column:
    return F.timestamp_micros(micros_col)


def sliding_windows(df: DataFrame, params: WindowParams = WindowParams(), scale: ScaleParams = ScaleParams(),
                    hot: HotKeys | str | None = "detect") -> DataFrame:
    """Give each sample its windows: one output row per (sample, window), at most ceil(size/stride) each.

    Windows are half-open, start at the session's first sample and advance by the stride only while they end
    at or before its last sample. A session shorter than the window is one window holding all its rows.
    Sessions below the minimum row count give nothing. The index counts every step, kept or not.
    """
    size, stride = micros(params.size_seconds), micros(params.stride_seconds)
    d = session_bounds(df, scale, hot).filter(F.col("session_rows") >= params.min_samples)
    start, end = F.unix_micros("session_start"), F.unix_micros("session_end")
    span, offset = end - start, F.unix_micros("timestamp") - start
    last = F.floor((span - size) / F.lit(stride))
    first_k = F.greatest(F.lit(0).cast("bigint"), F.floor((offset - size) / F.lit(stride)) + 1)
    last_k = F.least(F.floor(offset / F.lit(stride)), last)
    short = span < size
    d = (d.withColumn("__short", short).withColumn("__lo", first_k).withColumn("__hi", last_k)
         .filter(F.col("__short") | (F.col("__lo") <= F.col("__hi")))
         .withColumn("window_index", F.explode(
             F.when(F.col("__short"), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence("__lo", "__hi")))))
    begin = start + F.col("window_index") * stride
    return d.withColumns({
        "window_start": F.when(F.col("__short"), F.col("session_start")).otherwise(_at(begin)),
        "window_end": F.when(F.col("__short"), F.col("session_end")).otherwise(_at(begin + size)),
    }).drop("__short", "__lo", "__hi", "session_start", "session_end", "session_rows")


def session_windows(df: DataFrame) -> DataFrame:
    """One ungated window per session, keyed by the session alone."""
    return df.withColumn("window_index", F.lit(0).cast("bigint"))


def window_metadata(windowed: DataFrame) -> DataFrame:
    """One row per sliding window: bounds, the session's first user and device, row count and HR share."""
    return name_owner(windowed.groupBy(*SLIDING_KEYS).agg(*metadata_aggregates()))


def name_owner(windows: DataFrame) -> DataFrame:
    return windows.withColumnsRenamed({"session_user_id": "user_id", "session_device_id": "device_id"})


def metadata_aggregates() -> list[Column]:
    """Aggregates for :func:`window_metadata`; can be computed together with the features."""
    return [
        F.count(F.lit(1)).alias("n_samples"),
        (F.count("heart_rate_bpm") / F.count(F.lit(1))).alias("hr_ratio"),
    ]


def sliding_gate(windows: DataFrame, params: WindowParams = WindowParams()) -> DataFrame:
    """Add ``reason``: null for a kept window, else why it is dropped. Uses HR share after filling."""
    return windows.withColumn(
        "reason",
        F.when(F.col("n_samples") < params.min_samples, F.lit("insufficient_samples"))
        .when(F.col("hr_ratio") < params.min_hr_ratio, F.lit("insufficient_heart_rate")))


def keep(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("reason").isNull()).drop("reason")


def event_windows(samples: DataFrame, events: DataFrame,
                  params: EventWindowParams = EventWindowParams()) -> DataFrame:
    """Samples in the closed interval [T - size, T] of each event's session and device.

    ``events`` needs event_id, session_id, device_id, user_id and detected_at; the user is compared only when
    the event has one. Time is cut into buckets as wide as the window: an event looks into at most two, a
    sample lies in one, so a join key never pairs a whole session with all its events. Either side may be
    broadcast or the exchange skew-split; that is left to the optimizer.
    """
    size = micros(params.size_seconds)
    at = F.unix_micros("detected_at")
    wanted = events.select(
        "event_id", F.col("session_id"), F.col("device_id"), F.col("user_id").alias("__event_user"),
        F.timestamp_micros(at - size).alias("window_start"), F.col("detected_at").alias("window_end"),
        F.explode(F.sequence(F.floor((at - size) / F.lit(size)), F.floor(at / F.lit(size)))).alias("__bucket"))
    placed = samples.withColumn("__bucket", F.floor(F.unix_micros("timestamp") / F.lit(size)))
    joined = placed.join(wanted, ["session_id", "device_id", "__bucket"])
    inside = (F.col("timestamp") >= F.col("window_start")) & (F.col("timestamp") <= F.col("window_end"))
    user_ok = F.col("__event_user").isNull() | (F.col("__event_user") == F.col("user_id"))
    return joined.filter(inside & user_ok).drop("__bucket", "__event_user")


def event_gate_reason(n: Column, hr_ratio: Column, params: EventWindowParams = EventWindowParams()) -> Column:
    """Gate on raw samples: none, too few, or too small a share with heart rate."""
    return (F.when(F.coalesce(n, F.lit(0)) == 0, F.lit("missing_telemetry"))
            .when((n < params.min_samples) | (hr_ratio < params.min_hr_ratio), F.lit("insufficient_samples")))


def event_window_gate(events: DataFrame, windowed: DataFrame,
                      params: EventWindowParams = EventWindowParams()) -> DataFrame:
    """Every event with its raw row count, HR share and gate reason (null when the window is usable)."""
    counts = windowed.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_samples"),
        (F.count("heart_rate_bpm") / F.count(F.lit(1))).alias("hr_ratio"))
    joined = events.join(counts, "event_id", "left").withColumn("n_samples", F.coalesce("n_samples", F.lit(0).cast("bigint")))
    return joined.withColumn("reason", event_gate_reason(F.col("n_samples"), F.col("hr_ratio"), params))
