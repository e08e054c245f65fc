"""Watch snapshot against recomputed features: agreement is measured, never forced."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.quantiles import distribution
from pulseframe.params import ScaleParams

# Watch field -> (feature, absolute tolerance, relative tolerance).
COMPARED = {
    "heart_rate_mean": ("hr_mean", 0.5, 0.02),
    "heart_rate_max": ("hr_max", 0.5, 0.02),
    "heart_rate_slope_bpm_per_minute": ("hr_slope_bpm_per_min", 0.05, 0.05),
    "rmssd_millis": ("hrv_rmssd", 1.0, 0.05),
    "sdnn_millis": ("hrv_sdnn", 1.0, 0.05),
    "valid_sample_ratio": ("valid_sample_ratio", 0.01, 0.0),
    "sample_count": ("sample_count", 0.0, 0.0),
}
TOLERANCES = {watch: (atol, rtol) for watch, (_, atol, rtol) in COMPARED.items()}
DELTA_FIELD, DELTA_RULE, DELTA_TOLERANCE = "heart_rate_delta_from_baseline", "hr_mean - baseline.mean_heart_rate", (1.0, 0.05)

# Fields that exist on one side only, or that the samples cannot reproduce.
NOT_COMPARABLE = ("movement_magnitude_mean", "movement_variance")
WATCH_ONLY = ("last_sample_age_seconds",)
FEATURE_ONLY = (
    "hr_std", "hr_min", "ibi_available", "ibi_coverage_ratio", "skin_temp_mean",
    "quality_good_ratio", "quality_fair_ratio", "quality_poor_ratio", "window_duration_seconds",
)

_SNAPSHOT, _BASELINE = "watch_features_snapshot", "watch_baseline_snapshot"


def _watch(field: str) -> Column:
    return F.col(f"{_SNAPSHOT}.{field}").cast("double")


def _ml(ds: DataFrame, feature: str) -> Column:
    return (F.col(feature) if feature in ds.columns else F.lit(None)).cast("double")


def with_snapshot(ds: DataFrame) -> DataFrame:
    return ds.filter(F.col(_SNAPSHOT).isNotNull())


def parity_wide(ds: DataFrame) -> DataFrame:
    """One row per event with a snapshot: watch minus recomputed for each pair, null when a side is missing."""
    return with_snapshot(ds).select("event_id", *[
        (_watch(w) - _ml(ds, f)).alias(f"diff_{w}") for w, (f, _, _) in COMPARED.items() if f in ds.columns])


def _status(watch: Column, ml: Column, atol: float, rtol: float) -> Column:
    close = F.abs(watch - ml) <= F.lit(atol) + F.lit(rtol) * F.abs(ml)
    return (F.when(watch.isNull() & ml.isNull(), "both_missing").when(watch.isNull(), "watch_missing")
            .when(ml.isNull(), "ml_missing").when(close, "match").otherwise("diverging"))


def _pair(watch_field: str, against: str, name: str, watch: Column, ml: Column, tolerance: tuple[float, float]) -> Column:
    diff = watch - ml
    return F.struct(
        F.lit(watch_field).alias("watch_field"), F.lit(against).alias(name), watch.alias("watch_value"),
        ml.alias("ml_value"), diff.alias("diff"),
        F.when(ml != 0, F.abs(diff) / F.abs(ml)).alias("rel_diff"), _status(watch, ml, *tolerance).alias("status"))


def parity_rows(ds: DataFrame, tolerances: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Long form: event x field with both values, difference, relative difference and status."""
    limits = dict(TOLERANCES if tolerances is None else tolerances)
    pairs = [_pair(w, f, "ml_field", _watch(w), _ml(ds, f), limits.get(w, (0.0, 0.0))) for w, (f, _, _) in COMPARED.items()]
    return with_snapshot(ds).select("event_id", F.explode(F.array(*pairs)).alias("r")).select("event_id", "r.*")


def parity_derived(ds: DataFrame) -> DataFrame:
    """The watch's delta from baseline against mean heart rate minus the baseline snapshot's mean."""
    ml = _ml(ds, "hr_mean") - F.col(f"{_BASELINE}.mean_heart_rate")
    pair = _pair(DELTA_FIELD, DELTA_RULE, "expression", _watch(DELTA_FIELD), ml, DELTA_TOLERANCE)
    return with_snapshot(ds).select("event_id", pair.alias("r")).select("event_id", "r.*")


def parity_summary(rows: DataFrame, scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Per field: pairs, matches, divergences, missing sides, mean/median/max difference."""
    rows = rows.withColumn("abs_diff", F.abs("diff"))
    status = F.col("status")
    keys = ["watch_field", "ml_field"]
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count("diff").alias("n_both_present"),
        F.count_if(status == "match").alias("n_match"), F.count_if(status == "diverging").alias("n_diverging"),
        F.count_if(status == "watch_missing").alias("n_watch_missing"), F.count_if(status == "ml_missing").alias("n_ml_missing"),
        F.avg("rel_diff").alias("mean_rel_diff"))
    # One row per compared field on either side.
    sizes = distribution(rows, keys, "abs_diff", {"median_abs_diff": 0.5}, scale).select(
        *keys, F.col("mean").alias("mean_abs_diff"), "median_abs_diff", F.col("max").alias("max_abs_diff"))
    return counts.join(sizes, keys, "left")


def field_catalogue(ds: DataFrame) -> DataFrame:
    """Every field with its comparison class and, where compared, the events that have both sides."""
    entries = [(w, "compared", F.count(_watch(w) - _ml(ds, f))) for w, (f, _, _) in COMPARED.items()]
    entries += [(DELTA_FIELD, "derived", F.count(_watch(DELTA_FIELD) - (_ml(ds, "hr_mean") - F.col(f"{_BASELINE}.mean_heart_rate"))))]
    entries += [(w, "not_comparable", F.count(_watch(w))) for w in NOT_COMPARABLE]
    entries += [(w, "watch_only", F.count(_watch(w))) for w in WATCH_ONLY]
    entries += [(f, "ml_only", F.count(_ml(ds, f))) for f in FEATURE_ONLY]
    row = with_snapshot(ds).agg(*[n.alias(name) for name, _, n in entries])
    pairs = [F.struct(F.lit(name).alias("field"), F.lit(kind).alias("kind"), F.col(name).alias("n_present")) for name, kind, _ in entries]
    return row.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def parity_warnings(ds: DataFrame) -> DataFrame:
    """(warning, n): the dataset is empty, or rows have no snapshot."""
    row = ds.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(_SNAPSHOT).isNull()).alias("without"))
    marks = F.array_compact(F.array(
        F.when(F.col("n") == 0, F.struct(F.lit("empty_dataset").alias("warning"), F.col("n").alias("n"))),
        F.when(F.col("without") > 0, F.struct(F.lit("no_watch_snapshot").alias("warning"), F.col("without").alias("n")))))
    return row.select(F.explode(marks).alias("r")).select("r.*")
