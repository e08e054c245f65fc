"""Features of sliding windows without a row for every window and sample.

A session's time is cut into panes of gcd(size, stride) from its first sample. Samples are aggregated once per pane; window bounds are
pane bounds, so a window is a run of whole panes. As many panes as a window has form a block: a window is the end of one block from its first pane
on and the start of the next block up to its last pane. Running aggregates backward and forward inside a block give both parts for all
windows, so the work grows with samples, panes and windows, and not with how much windows overlap.

Only windows that hold a sample are made: each by the first pane in it, which knows the pane before.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.columns import NN_STEP_MS, finite_or_null, micros
from pulseframe.functions.scale import HotKeys, hot_keys, ordered
from pulseframe.operators.clean import clean
from pulseframe.operators.windows import session_bounds, sliding_gate
from pulseframe.params import RunParams, ScaleParams, WindowParams
from pulseframe.session import cut_lineage

# Sums are taken around these points; any value gives the same result, these keep digits.
_HR_CENTRE, _TEMP_CENTRE = 75.0, 33.0
_OWNER = ["session_id", "session_user_id", "session_device_id", "session_start", "session_end"]

_SUMS = {
    "n": "count(1)", "hr_n": "count(hr)", "hr_y": "sum(hr)", "hr_yy": "sum(hr * hr)", "temp_n": "count(temp)", "temp_y": "sum(temp)", "temp_yy": "sum(temp * temp)",
    # Minutes since the start of the pane's block, for its part up to a pane, and to the block's end, for its part from a pane on.
    "x": "sum(IF(hr IS NOT NULL, x, NULL))", "xx": "sum(IF(hr IS NOT NULL, x * x, NULL))", "xy": "sum(x * hr)",
    "b": "sum(IF(hr IS NOT NULL, b, NULL))", "bb": "sum(IF(hr IS NOT NULL, b * b, NULL))", "by": "sum(b * hr)",
    "ibi_rows": "count(ibi)", "ibi_n": "sum(ibi.n)", "d1": "sum(ibi.d1)", "d2": "sum(ibi.d2)",
    "ss": "sum(ibi.ss) + coalesce(sum(inner_jump * inner_jump), 0D)",
    "over": f"sum(ibi.over) + count_if(abs(inner_jump) > {NN_STEP_MS}D)",
    "good": "count_if(quality_heart_rate = 'good')", "fair": "count_if(quality_heart_rate = 'fair')", "poor": "count_if(quality_heart_rate = 'poor')",
    "valid": "count_if(hr IS NOT NULL AND coalesce(quality_heart_rate, '') != 'poor')",
}
_LOWS = {"hr_low": "min(hr)", "temp_low": "min(temp)", "hr_first": "min(IF(hr IS NOT NULL, t, NULL))", "first": "min(t)"}
_HIGHS = {"hr_high": "max(hr)", "temp_high": "max(temp)", "hr_last": "max(IF(hr IS NOT NULL, t, NULL))", "last": "max(t)"}


def pane_size(params: WindowParams) -> int:
    """Microseconds of a pane: the longest that every window bound is a multiple of."""
    return gcd(micros(params.size_seconds), micros(params.stride_seconds))


def pane_aggregates(cleaned: DataFrame, params: WindowParams = WindowParams(), scale: ScaleParams = ScaleParams(),
                    hot: HotKeys | str | None = "detect") -> DataFrame:
    """One row per session and pane with a sample, of sessions with enough rows. ``jump``: from the interval before the pane to its first."""
    size, pane = micros(params.size_seconds), pane_size(params)
    at = F.unix_micros("timestamp") - F.unix_micros("session_start")
    block = F.floor(F.col("t") / F.lit(size))
    jump = F.when(F.col("ibi.n") > 0, F.col("ibi.first") - F.col("ibi_prev.value"))
    before = F.floor((F.unix_micros("ibi_prev.at") - F.unix_micros("session_start")) / F.lit(pane))
    d = session_bounds(cleaned, scale, hot).filter(F.col("session_rows") >= params.min_samples).withColumn("t", at).withColumns({
        "pane": F.floor(F.col("t") / F.lit(pane)), "hr": F.col("heart_rate_bpm") - _HR_CENTRE, "temp": F.col("skin_temperature_celsius") - _TEMP_CENTRE,
        "x": (F.col("t") - block * size) / F.lit(6e7), "b": (F.col("t") - block * size - size) / F.lit(6e7), "__jump": jump, "__from": before})
    inner = F.col("__from") == F.col("pane")
    d = d.withColumns({"inner_jump": F.when(inner, F.col("__jump")),
                       "outer": F.when(F.col("__jump").isNotNull() & ~inner, F.struct(F.col("__jump").alias("v"), F.col("__from").alias("pane")))})
    # Only the first sample with an interval looks out of its pane, so there is at most one such difference.
    return d.groupBy(*_OWNER, "pane").agg(*[F.expr(v).alias(k) for k, v in {**_SUMS, **_LOWS, **_HIGHS}.items()], F.max("outer").alias("jump"))


def _windows(panes: DataFrame, params: WindowParams, scale: ScaleParams, hot: HotKeys | str | None) -> DataFrame:
    """The windows that hold a pane: window_index and its first pane, once each."""
    size, stride, pane = micros(params.size_seconds), micros(params.stride_seconds), pane_size(params)
    step, width = stride // pane, size // pane
    span = F.unix_micros("session_end") - F.unix_micros("session_start")
    last = F.when(span < size, F.lit(0)).otherwise(F.floor((span - size) / F.lit(stride))).cast("bigint")
    seen = ordered(panes.select(*_OWNER, "pane"), ["session_id"], ["pane"], carried={"__before": (F.col("pane"), False)}, scale=scale, hot=hot)
    low = F.greatest(F.lit(0).cast("bigint"), F.floor((F.col("pane") - width) / F.lit(step)) + 1,
                     F.coalesce(F.floor(F.col("__before") / F.lit(step)) + 1, F.lit(0).cast("bigint")))
    high = F.least(F.floor(F.col("pane") / F.lit(step)), last)
    found = seen.withColumns({"__low": low, "__high": high}).filter("__low <= __high")
    return found.select(*_OWNER, F.explode(F.sequence("__low", "__high")).alias("window_index")).withColumn("__first", F.col("window_index") * step)


def pane_features(panes: DataFrame, params: RunParams = RunParams(), scale: ScaleParams = ScaleParams(), hot: HotKeys | str | None = "detect",
                  as_of: Column | None = None) -> DataFrame:
    """Metadata, ``reason`` and features of each sliding window, from :func:`pane_aggregates`."""
    width = micros(params.window.size_seconds) // pane_size(params.window)
    windows = _windows(panes, params.window, scale, hot)
    # A window that starts a block is that block; any other ends inside the next one.
    marks = windows.withColumn("__end", F.explode(F.array(F.lit(False), F.lit(True)))).filter(~F.col("__end") | (F.col("__first") % width != 0))
    marks = marks.withColumn("pane", F.col("__first") + F.when(F.col("__end"), width - 1).otherwise(0))
    laid = panes.unionByName(marks, allowMissingColumns=True).withColumn("block", F.floor(F.col("pane") / F.lit(width)))

    by = Window.partitionBy("session_id", "block")
    mark, frame = F.col("window_index").isNotNull(), (Window.unboundedPreceding, 0)
    up, down = by.orderBy("pane", mark).rowsBetween(*frame), by.orderBy(F.desc("pane"), mark).rowsBetween(*frame)
    large = (F.abs("jump.v") > NN_STEP_MS).cast("long")
    own = F.col("block") == F.floor(F.col("jump.pane") / F.lit(width))
    square = F.col("jump.v") * F.col("jump.v")

    def running(w, prefix: str) -> dict[str, Column]:
        picks = [(F.sum, _SUMS), (F.min, _LOWS), (F.max, _HIGHS)]
        return {f"{prefix}_{c}": pick(c).over(w) for pick, names in picks for c in names}

    # Up to a pane: differences inside the block, and the one that looks out of it. From a pane on: all but that of the first pane with an interval.
    rest = {"ss": F.sum(square).over(down) - F.coalesce(square, F.lit(0.0)), "over": F.sum(large).over(down) - F.coalesce(large, F.lit(0))}
    laid = laid.withColumns({
        **running(up, "p"), "p_jss": F.sum(F.when(own, square)).over(up), "p_jover": F.sum(F.when(own, large)).over(up),
        "p_head": F.first(F.when(~own, F.struct(square.alias("ss"), large.alias("over"), F.col("jump.pane").alias("pane"))), ignorenulls=True).over(up)})
    laid = laid.withColumns({
        **running(down, "r"), "__rest": F.when(F.col("ibi_n") > 0, F.struct(*[v.alias(k) for k, v in rest.items()]))})
    laid = laid.withColumn("r_jump", F.last("__rest", ignorenulls=True).over(down))
    marks = laid.filter(mark)
    parts = [c for c in marks.columns if c.startswith(("p_", "r_"))]
    got = marks.groupBy(*_OWNER, "window_index", "__first").agg(*[
        F.first(F.when(F.col("__end") == F.lit(c.startswith("p_")), F.col(c)), ignorenulls=True).alias(c) for c in parts])
    return sliding_gate(finite_or_null(_assembled(got, params, as_of)), params.window)


def _assembled(w: DataFrame, params: RunParams, as_of: Column | None) -> DataFrame:
    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def total(name: str, back: str | None = None) -> Column:
        return zero(f"p_{name}") + zero(f"r_{back or name}")

    def low(name: str) -> Column:
        return F.least(f"p_{name}", f"r_{name}")

    def high(name: str) -> Column:
        return F.greatest(f"p_{name}", f"r_{name}")

    n, hr_n, k = total("n"), total("hr_n"), total("ibi_n")
    begin = F.unix_micros("session_start")

    def mean(group: str, centre: float) -> Column:
        return F.when(total(f"{group}_n") > 0, total(f"{group}_y") / total(f"{group}_n") + centre)

    def std(group: str) -> Column:
        count, y = total(f"{group}_n"), total(f"{group}_y")
        spread = F.greatest(total(f"{group}_yy") - y * y / count, F.lit(0.0))
        # Equal values have no deviation, whatever their sums were rounded to.
        return F.when(low(f"{group}_low") == high(f"{group}_high"), 0.0).when(count > 1, F.sqrt(spread / (count - 1)))

    x, xx, xy = total("x", "b"), total("xx", "bb"), total("xy", "by")
    slope = (hr_n * xy - x * total("hr_y")) / (hr_n * xx - x * x)
    # The difference at the start of the next block counts when the interval before it lies in the window.
    reaches = F.coalesce(F.col("p_head.pane") >= F.col("__first"), F.lit(False))

    def linked(name: str) -> Column:
        return total(name) + zero(f"p_j{name}") + zero(f"r_jump.{name}") + F.when(reaches, F.col(f"p_head.{name}")).otherwise(F.lit(0))

    def hrv(value: Column) -> Column:
        return F.when(k >= 3, value)

    now = as_of if as_of is not None else F.current_timestamp()
    empty = F.lit(None).cast("double")
    rules = {
        "hr_mean": mean("hr", _HR_CENTRE), "hr_std": std("hr"),
        "hr_min": low("hr_low") + _HR_CENTRE, "hr_max": high("hr_high") + _HR_CENTRE,
        "hr_slope_bpm_per_min": F.when(hr_n == 1, 0.0).when((hr_n > 1) & (low("hr_first") < high("hr_last")), slope),
        "hrv_rmssd": hrv(F.sqrt(linked("ss") / (k - 1))),
        "hrv_sdnn": hrv(F.sqrt(F.greatest(total("d2") - total("d1") * total("d1") / k, F.lit(0.0)) / (k - 1))),
        "hrv_pnn50": hrv(linked("over") * 100.0 / (k - 1)),
        "ibi_available": F.when(total("ibi_rows") > 0, 1.0).otherwise(0.0), "ibi_coverage_ratio": total("ibi_rows") / n,
        "movement_magnitude_mean": empty, "movement_variance_mean": empty,
        "skin_temp_mean": mean("temp", _TEMP_CENTRE), "skin_temp_std": std("temp"),
        "quality_good_ratio": total("good") / n, "quality_fair_ratio": total("fair") / n, "quality_poor_ratio": total("poor") / n,
        "valid_sample_ratio": total("valid") / n, "window_duration_seconds": (high("last") - low("first")) / F.lit(1e6), "sample_count": n,
        "last_sample_age_seconds": (F.unix_micros(now) - begin - high("last")) / F.lit(1e6),
    }
    size, stride = micros(params.window.size_seconds), micros(params.window.stride_seconds)
    short = F.unix_micros("session_end") - begin < size
    start = begin + F.col("window_index") * stride
    return w.select(
        "session_id", "window_index", F.timestamp_micros(start).alias("window_start"),
        F.when(short, F.col("session_end")).otherwise(F.timestamp_micros(start + size)).alias("window_end"),
        F.col("session_user_id").alias("user_id"), F.col("session_device_id").alias("device_id"), n.cast("long").alias("n_samples"),
        (hr_n / n).alias("hr_ratio"), *[rules[name].cast("double").alias(name) for name in params.features.names()])


def sliding_pane_features(samples: DataFrame, params: RunParams = RunParams(), scale: ScaleParams = ScaleParams(),
                          hot: HotKeys | str | None = "detect", as_of: Column | None = None) -> DataFrame:
    """The rows of :func:`pulseframe.plans.windows.sliding_features` by way of panes: the way to take when windows overlap much."""
    if hot == "detect":
        hot = hot_keys(samples, ["session_id"], scale)
    # Panes are read twice, for the windows and for the sums; the samples behind them once.
    panes = cut_lineage(pane_aggregates(clean(samples, params.clean, "session_id", scale, hot), params.window, scale, hot))
    return pane_features(panes, params, scale, hot, as_of)
