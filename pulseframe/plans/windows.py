"""Samples to gated, featured sliding windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from pulseframe.functions.scale import HotKeys, hot_keys
from pulseframe.operators.clean import clean, link_ibi
from pulseframe.operators.features import window_features
from pulseframe.operators.windows import (
    SLIDING_KEYS, metadata_aggregates, name_owner, session_windows, sliding_gate, sliding_windows,
)
from pulseframe.params import RunParams, ScaleParams


def sliding_features(samples: DataFrame, params: RunParams = RunParams(), scale: ScaleParams = ScaleParams(),
                     hot: HotKeys | str | None = "detect", as_of: Column | None = None) -> DataFrame:
    """Clean per session, cut sliding windows, aggregate once: metadata, ``reason`` and features per window.

    Without hot sessions the whole chain needs one exchange, on the session id.
    """
    if hot == "detect":
        hot = hot_keys(samples, ["session_id"], scale)
    cleaned = clean(samples, params.clean, "session_id", scale, hot)
    windowed = sliding_windows(cleaned, params.window, scale, hot)
    got = window_features(windowed, SLIDING_KEYS, params.features, as_of=as_of, extra=metadata_aggregates())
    return sliding_gate(name_owner(got), params.window)


def session_features(samples: DataFrame, params: RunParams = RunParams(), scale: ScaleParams = ScaleParams(),
                     hot: HotKeys | str | None = "detect", extra=(), as_of: Column | None = None) -> DataFrame:
    """One uncleaned, ungated window per session with its features."""
    linked = link_ibi(samples, "session_id", scale, hot)
    return window_features(session_windows(linked), ["session_id"], params.features, anchor=None, as_of=as_of, extra=extra)
