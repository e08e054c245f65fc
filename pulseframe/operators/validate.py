"""Data-quality checks as tables of issues (level, check, key, value); warnings never fail a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.columns import array_mean
from pulseframe.functions.scale import HotKeys, ordered
from pulseframe.params import ScaleParams

# Limits of the checks.
HR_LOW, HR_HIGH = 30.0, 220.0
MAX_BATCH_SAMPLES = 600
MAX_GAP_SECONDS = 300.0
MIN_HR_AVAILABILITY = 0.5
IBI_TOLERANCE = 0.2
MAX_POOR_RATIO = 0.3
REQUIRED_COLUMNS = ("timestamp", "heart_rate_bpm", "user_id", "session_id")


def _issue(level: str, check: str, value: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), F.lit(check).alias("check"), value.cast("double").alias("value"))


def hr_out_of_range(hr: Column) -> Column:
    return (hr < HR_LOW) | (hr > HR_HIGH)


def neighbour_gaps(samples: Column) -> Column:
    """Seconds between neighbouring samples in document order."""
    at = F.transform(samples, lambda s: F.unix_micros(s["timestamp"]))
    pairs = F.greatest(F.size(at) - 1, F.lit(0))
    return F.zip_with(F.slice(at, 2, pairs), F.slice(at, 1, pairs), lambda b, a: (b - a) / F.lit(1e6))


def _ibi_error(s: Column) -> Column:
    """Relative distance of the mean interval from 60000 / heart rate; null when either is missing."""
    expected = F.lit(60000.0) / s["heart_rate_bpm"]
    usable = s["heart_rate_bpm"].isNotNull() & (s["heart_rate_bpm"] != 0) & (F.size(s["ibi_ms"]) > 0)
    return F.when(usable, F.abs(expected - array_mean(s["ibi_ms"])) / expected)


def batch_issues(samples: Column) -> Column:
    """All issues of one batch as an array. Array functions on the document itself: no shuffle, no explode."""
    n = F.size(samples)
    gaps = neighbour_gaps(samples)
    with_hr = F.size(F.filter(samples, lambda s: s["heart_rate_bpm"].isNotNull()))
    poor = F.size(F.filter(samples, lambda s: s["quality"]["heart_rate"] == "poor"))
    hr_share = F.when(n > 0, with_hr / n).otherwise(F.lit(0.0))
    single = F.array_compact(F.array(
        F.when(n == 0, _issue("error", "no_samples", n)),
        F.when(n > MAX_BATCH_SAMPLES, _issue("warning", "too_many_samples", n)),
        F.when(F.exists(gaps, lambda g: g < 0), _issue("warning", "unsorted_samples", F.size(F.filter(gaps, lambda g: g < 0)))),
        F.when(F.array_max(gaps) > MAX_GAP_SECONDS, _issue("warning", "large_gap", F.array_max(gaps))),
        F.when(hr_share < MIN_HR_AVAILABILITY, _issue("warning", "low_hr_availability", hr_share)),
        F.when((n > 0) & (poor / F.greatest(n, F.lit(1)) > MAX_POOR_RATIO), _issue("warning", "high_poor_ratio", poor / F.greatest(n, F.lit(1))))))
    out_of_range = F.transform(
        F.filter(samples, lambda s: F.coalesce(hr_out_of_range(s["heart_rate_bpm"]), F.lit(False))),
        lambda s: _issue("warning", "hr_out_of_range", s["heart_rate_bpm"]))
    inconsistent = F.transform(
        F.filter(samples, lambda s: F.coalesce(_ibi_error(s) > IBI_TOLERANCE, F.lit(False))),
        lambda s: _issue("warning", "ibi_inconsistent", _ibi_error(s)))
    return F.concat(single, out_of_range, inconsistent)


def validate_batches(batches: DataFrame) -> DataFrame:
    """Issues of nested batch documents, keyed by batch id."""
    return (batches.select(F.col("batch_id").alias("key"), F.explode(batch_issues(F.col("samples"))).alias("i"))
            .select("i.level", "i.check", "key", "i.value"))


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def null_counts(df: DataFrame, columns: Sequence[str] = ("timestamp", "user_id", "session_id")) -> DataFrame:
    """Errors for columns that must not be null, from one aggregation."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in columns])).alias("r"))
            .select("r.*").filter(F.col("value") > 0)
            .select(F.lit("error").alias("level"), F.lit("null_values").alias("check"), "key", "value"))


def backward_steps(df: DataFrame, order: Sequence[str] = ("sequence", "pos"), scale: ScaleParams = ScaleParams(),
                   hot: HotKeys | str | None = "detect") -> DataFrame:
    """One warning per session whose timestamps go back in the given input order, with the number of steps."""
    narrow = df.select("session_id", "timestamp", *[c for c in order if c not in ("session_id", "timestamp")])
    stepped = ordered(narrow, ["session_id"], order, lambda d, w: d.withColumn("__before", F.lag("timestamp").over(w)),
                      before=1, scale=scale, hot=hot)
    return (stepped.filter(F.col("timestamp") < F.col("__before")).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit("warning").alias("level"), F.lit("timestamps_not_monotonic").alias("check"),
                    F.col("session_id").alias("key"), F.col("n").cast("double").alias("value")))


def hr_range_issue(df: DataFrame) -> DataFrame:
    """One warning for the whole table when any heart rate is out of range, with the count."""
    return (df.agg(F.count_if(hr_out_of_range(F.col("heart_rate_bpm"))).alias("n")).filter(F.col("n") > 0)
            .select(F.lit("warning").alias("level"), F.lit("hr_out_of_range").alias("check"),
                    F.lit("heart_rate_bpm").alias("key"), F.col("n").cast("double").alias("value")))


def validate_samples(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, order: Sequence[str] = ("sequence", "pos"),
                     scale: ScaleParams = ScaleParams(), hot: HotKeys | str | None = "detect") -> DataFrame:
    """Issues of a flat sample table. Missing required columns stop the other checks."""
    missing = missing_columns(df, required)
    if missing:
        rows = [("error", "missing_column", c, 1.0) for c in missing]
        return df.sparkSession.createDataFrame(rows, "level string, check string, key string, value double")
    present = [c for c in ("timestamp", "user_id", "session_id") if c in df.columns]
    issues = null_counts(df, present)
    if {"session_id", "timestamp", *order} <= set(df.columns):
        issues = issues.unionByName(backward_steps(df, order, scale, hot))
    if "heart_rate_bpm" in df.columns:
        issues = issues.unionByName(hr_range_issue(df))
    return issues


def is_valid(issues: DataFrame) -> bool:
    return issues.filter(F.col("level") == "error").isEmpty()


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("level", "check").agg(F.count(F.lit(1)).alias("n"))


def sequence_gaps(batches: DataFrame, scale: ScaleParams = ScaleParams(),
                  hot: HotKeys | str | None = "detect") -> DataFrame:
    """Jumps in a session's batch sequence, with the number of missing batches."""
    seen = batches.select("session_id", "sequence").distinct()
    stepped = ordered(seen, ["session_id"], ["sequence"], lambda d, w: d.withColumn("previous", F.lag("sequence").over(w)),
                      before=1, scale=scale, hot=hot)
    return (stepped.filter(F.col("sequence") > F.col("previous") + 1)
            .select("session_id", "previous", "sequence", (F.col("sequence") - F.col("previous") - 1).alias("missing")))
