"""Cleaning of flat samples per session (or per event window): bounded fills, rolling statistics, outliers.

``key`` is "session_id" for whole sessions and "event_id" for event windows, where one sample may belong to
several events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from pulseframe.functions.columns import ibi_summary_struct
from pulseframe.functions.scale import HotKeys, ordered
from pulseframe.params import CleanParams, ScaleParams
from pulseframe.schemas import SAMPLE_ORDER

QUALITY_COLUMNS = ("quality_heart_rate", "quality_ibi", "quality_wearing_state")
_STD_GUARD = 1e-6  # fixed value: keeps the z-score finite when the rolling deviation is zero


def order_samples(df: DataFrame) -> DataFrame:
    """User, session, time order, for export only; operators state their own order and need no global sort."""
    return df.orderBy("user_id", "session_id", *SAMPLE_ORDER)


def _filled(name: str, rows: int, window: WindowSpec) -> Column:
    return F.last(name, ignorenulls=True).over(window.rowsBetween(-rows, 0))


def _rolling_frame(window: WindowSpec, params: CleanParams) -> WindowSpec:
    back = params.rolling_rows // 2
    return window.rowsBetween(-back, params.rolling_rows - back - 1)


def _with_rolling(df: DataFrame, window: WindowSpec, params: CleanParams) -> DataFrame:
    frame = _rolling_frame(window, params)
    seen = F.count("heart_rate_bpm").over(frame)
    enough = seen >= params.rolling_min
    return df.withColumns({
        "hr_rolling_count": seen,
        "hr_rolling_mean": F.when(enough, F.avg("heart_rate_bpm").over(frame)),
        "hr_rolling_std": F.when(enough, F.stddev_samp("heart_rate_bpm").over(frame)),
    })


def _zscore() -> Column:
    return F.abs(F.col("heart_rate_bpm") - F.col("hr_rolling_mean")) / (F.col("hr_rolling_std") + F.lit(_STD_GUARD))


def _is_outlier(params: CleanParams) -> Column:
    hit = (F.col("hr_z_score") > params.outlier_sigma) & (F.col("hr_rolling_count") >= params.outlier_min)
    return F.coalesce(hit, F.lit(False))


def fill_hr(df: DataFrame, params: CleanParams = CleanParams(), key: str = "session_id",
            scale: ScaleParams = ScaleParams(), hot: HotKeys | str | None = "detect") -> DataFrame:
    """Forward fill of heart rate over at most ``hr_fill_rows`` consecutive rows."""
    rows = params.hr_fill_rows
    return ordered(df, [key], SAMPLE_ORDER, lambda d, w: d.withColumn("heart_rate_bpm", _filled("heart_rate_bpm", rows, w)),
                   before=rows, scale=scale, hot=hot)


def fill_temp(df: DataFrame, params: CleanParams = CleanParams(), key: str = "session_id",
              scale: ScaleParams = ScaleParams(), hot: HotKeys | str | None = "detect") -> DataFrame:
    """Forward fill of skin temperature over at most ``temp_fill_rows`` consecutive rows."""
    rows = params.temp_fill_rows
    return ordered(df, [key], SAMPLE_ORDER,
                   lambda d, w: d.withColumn("skin_temperature_celsius", _filled("skin_temperature_celsius", rows, w)),
                   before=rows, scale=scale, hot=hot)


def fill_quality(df: DataFrame, key: str = "session_id", scale: ScaleParams = ScaleParams(),
                 hot: HotKeys | str | None = "detect") -> DataFrame:
    """Unbounded forward fill of the quality columns that are present."""
    present = {c: (F.col(c), True) for c in QUALITY_COLUMNS if c in df.columns}
    return ordered(df, [key], SAMPLE_ORDER, carried=present, scale=scale, hot=hot)


def rolling_stats(df: DataFrame, params: CleanParams = CleanParams(), key: str = "session_id",
                  scale: ScaleParams = ScaleParams(), hot: HotKeys | str | None = "detect") -> DataFrame:
    """Centred rolling count, mean and sample deviation of heart rate."""
    n = params.rolling_rows
    return ordered(df, [key], SAMPLE_ORDER, lambda d, w: _with_rolling(d, w, params),
                   before=n, after=n, scale=scale, hot=hot)


def hr_zscore(df: DataFrame) -> DataFrame:
    """Distance from the rolling mean in rolling deviations; needs :func:`rolling_stats` columns."""
    return df.withColumn("hr_z_score", _zscore())


def flag_outliers(df: DataFrame, params: CleanParams = CleanParams()) -> DataFrame:
    """Mark, never drop: z above sigma and enough heart-rate values in the frame."""
    return df.withColumn("hr_is_outlier", _is_outlier(params))


def with_ibi(df: DataFrame) -> DataFrame:
    """Per-sample IBI sums in one struct, so later shuffles need not carry the arrays. Kept when already there."""
    if "ibi" in df.columns:
        return df
    return df.withColumn("ibi", ibi_summary_struct("ibi_ms"))


def _ibi_link() -> dict[str, tuple[Column, bool]]:
    kept = F.col("ibi.n") > 0
    return {"ibi_prev": (F.when(kept, F.struct(F.col("ibi.last").alias("value"), F.col("timestamp").alias("at"))), False)}


def link_ibi(df: DataFrame, key: str = "session_id", scale: ScaleParams = ScaleParams(),
             hot: HotKeys | str | None = "detect") -> DataFrame:
    """Add ``ibi`` and the last plausible IBI value before each sample, with its time.

    Successive differences across samples then belong to a window exactly when that earlier sample does,
    so HRV of any window is a plain sum and no array of a whole window is ever built.
    """
    return ordered(with_ibi(df), [key], SAMPLE_ORDER, carried=_ibi_link(), scale=scale, hot=hot)


def clean(df: DataFrame, params: CleanParams = CleanParams(), key: str = "session_id",
          scale: ScaleParams = ScaleParams(), hot: HotKeys | str | None = "detect") -> DataFrame:
    """All cleaning steps in one pass over one partitioning: fills, outlier flag and IBI links."""

    def bounded(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumns({
            "heart_rate_bpm": _filled("heart_rate_bpm", params.hr_fill_rows, w),
            "skin_temperature_celsius": _filled("skin_temperature_celsius", params.temp_fill_rows, w),
        })
        d = flag_outliers(hr_zscore(_with_rolling(d, w, params)), params)
        return d.drop("hr_rolling_count", "hr_rolling_mean", "hr_rolling_std")

    carried = {c: (F.col(c), True) for c in QUALITY_COLUMNS if c in df.columns}
    carried.update(_ibi_link())
    before = max(params.hr_fill_rows + params.rolling_rows, params.temp_fill_rows)
    return ordered(with_ibi(df), [key], SAMPLE_ORDER, bounded, before, params.rolling_rows, carried, scale, hot)
