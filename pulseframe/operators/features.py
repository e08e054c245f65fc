"""Window features as one grouped aggregation; every aggregate combines on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.columns import NN_STEP_MS, finite_or_null
from pulseframe.params import FeatureToggles

def _std(name: str) -> str:
    """Sample deviation; a single value has deviation 0, none has no deviation."""
    return f"CASE WHEN count({name}) = 1 THEN 0D ELSE stddev_samp({name}) END"


def _share(condition: str) -> str:
    return f"avg(IF({condition}, 1D, 0D))"


def _hrv(value: str) -> str:
    """HRV needs three plausible intervals."""
    return f"CASE WHEN sum(ibi.n) >= 3 THEN {value} END"


def feature_columns(toggles: FeatureToggles, anchor: str | None = "window_start",
                    as_of: Column | None = None) -> list[Column]:
    """Aggregate expressions of the chosen features, in output order."""
    # The slope does not depend on where minutes start; counting them from the window start keeps digits.
    minutes = f"(unix_micros(timestamp) - unix_micros({anchor})) / 6e7D" if anchor else "unix_micros(timestamp) / 6e7D"
    # A difference to the previous sample counts only when that sample is in the window too.
    linked = "ibi.n > 0" + (f" AND ibi_prev.at >= {anchor}" if anchor else "")
    jump = f"CASE WHEN {linked} THEN ibi.first - ibi_prev.value END"
    squares = f"(sum(ibi.ss) + coalesce(sum({jump} * {jump}), 0D))"
    large = f"(sum(ibi.over) + coalesce(sum(IF(abs({jump}) > {NN_STEP_MS}D, 1L, 0L)), 0L))"
    spread = "greatest(sum(ibi.d2) - sum(ibi.d1) * sum(ibi.d1) / sum(ibi.n), 0D)"
    rules = {
        "hr_mean": "avg(heart_rate_bpm)",
        "hr_std": _std("heart_rate_bpm"),
        "hr_min": "min(heart_rate_bpm)",
        "hr_max": "max(heart_rate_bpm)",
        # A single value has slope 0.
        "hr_slope_bpm_per_min": f"CASE WHEN count(heart_rate_bpm) = 1 THEN 0D ELSE regr_slope(heart_rate_bpm, {minutes}) END",
        "hrv_rmssd": _hrv(f"sqrt({squares} / (sum(ibi.n) - 1))"),
        "hrv_sdnn": _hrv(f"sqrt({spread} / (sum(ibi.n) - 1))"),
        "hrv_pnn50": _hrv(f"{large} * 100D / (sum(ibi.n) - 1)"),
        "ibi_available": "max(IF(ibi IS NOT NULL, 1D, 0D))",
        "ibi_coverage_ratio": _share("ibi IS NOT NULL"),
        # Placeholders: no accelerometer signal reaches the samples.
        "movement_magnitude_mean": "max(double(NULL))",
        "movement_variance_mean": "max(double(NULL))",
        "skin_temp_mean": "avg(skin_temperature_celsius)",
        "skin_temp_std": _std("skin_temperature_celsius"),
        "quality_good_ratio": _share("quality_heart_rate = 'good'"),
        "quality_fair_ratio": _share("quality_heart_rate = 'fair'"),
        "quality_poor_ratio": _share("quality_heart_rate = 'poor'"),
        "valid_sample_ratio": _share("heart_rate_bpm IS NOT NULL AND coalesce(quality_heart_rate, '') != 'poor'"),
        "window_duration_seconds": "(unix_micros(max(timestamp)) - unix_micros(min(timestamp))) / 1e6D",
        "sample_count": "double(count(1))",
    }
    now = as_of if as_of is not None else F.current_timestamp()

    def column(name: str) -> Column:
        if name == "last_sample_age_seconds":
            return (F.unix_micros(now) - F.unix_micros(F.max("timestamp"))) / F.lit(1e6)
        return F.expr(rules[name])

    return [column(name).alias(name) for name in toggles.names()]


def window_features(windowed: DataFrame, keys: Sequence[str], toggles: FeatureToggles = FeatureToggles(),
                    anchor: str | None = "window_start", as_of: Column | None = None,
                    extra: Sequence[Column] = ()) -> DataFrame:
    """One row per window: ``keys``, then ``extra`` aggregates, then the chosen features.

    ``windowed`` comes from cleaning (or :func:`link_ibi`) followed by a window operator. ``anchor`` is the
    window-start column, or None for one window per whole key. ``as_of`` is the reference time of
    ``last_sample_age_seconds``.
    """
    got = windowed.groupBy(*keys).agg(*extra, *feature_columns(toggles, anchor, as_of))
    return finite_or_null(got)
