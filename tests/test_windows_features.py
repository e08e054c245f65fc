from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.functions.columns import finite_or_null
from pulseframe.operators import clean as cl
from pulseframe.operators import windows as wn
from pulseframe.operators.features import window_features
from pulseframe.params import CleanParams, EventWindowParams, FeatureToggles, RunParams, WindowParams
from pulseframe.plans.windows import session_features, sliding_features
from tests.helpers import T0, sample_rows, samples

ALL = RunParams(features=FeatureToggles.all_on())


def at():
    return F.lit("2026-01-02").cast("timestamp")


def features(spark, rows, params=ALL):
    return {r.window_index: r for r in sliding_features(samples(spark, rows), params, as_of=at()).collect()}


def test_fill_limits_match_pandas(spark):
    rng = np.random.default_rng(1)
    values = [float(x) if rng.random() < 0.15 else None for x in rng.normal(70, 5, 300)]
    s = samples(spark, sample_rows(300, hr=lambda i: values[i]))
    import pandas as pd
    got = cl.fill_hr(s, CleanParams(hr_fill_rows=4)).orderBy("pos").toPandas()["heart_rate_bpm"]
    want = pd.Series(values, dtype=float).ffill(limit=4)
    pd.testing.assert_series_equal(got, want, check_names=False)
    roll = cl.rolling_stats(s).orderBy("pos").toPandas()
    r = pd.Series(values, dtype=float).rolling(10, center=True, min_periods=3)
    np.testing.assert_allclose(roll["hr_rolling_mean"], r.mean(), rtol=1e-9)
    np.testing.assert_allclose(roll["hr_rolling_std"], r.std(), rtol=1e-6, atol=1e-9)


def test_outliers_are_marked_not_dropped(spark):
    rows = sample_rows(60, hr=lambda i: 200.0 if i == 30 else 70.0 + i % 2)
    assert cl.clean(samples(spark, rows)).filter("hr_is_outlier").count() == 0  # three sigma is out of reach in ten values
    got = cl.clean(samples(spark, rows), CleanParams(outlier_sigma=2.5))
    assert [r.pos for r in got.filter("hr_is_outlier").collect()] == [30] and got.count() == 60


def test_sliding_windows(spark):
    got = features(spark, sample_rows(121))
    assert sorted(got) == [0, 1, 2]
    assert [got[k].n_samples for k in (0, 1, 2)] == [60, 60, 60]  # half open
    assert got[1].window_start.timestamp() == T0.timestamp() + 30


def test_exact_duration_takes_the_sliding_branch(spark):
    got = features(spark, sample_rows(61))
    assert list(got) == [0] and got[0].n_samples == 60


def test_short_session_is_one_window(spark):
    got = features(spark, sample_rows(40))
    assert list(got) == [0] and got[0].n_samples == 40 and got[0].window_end.timestamp() == T0.timestamp() + 39
    assert features(spark, sample_rows(9)) == {}


def test_index_counts_dropped_windows(spark):
    rows = sample_rows(60) + [(*r[:4], 1, *r[5:]) for r in sample_rows(61, start=T0 + timedelta(seconds=180))]
    got = {k: v.reason for k, v in features(spark, rows).items()}
    assert got[0] is None and got[6] is None and 3 not in got
    assert sorted(k for k, r in got.items() if r is None) == [0, 1, 5, 6]


def test_hr_gate_counts_filled_values(spark):
    sparse = sample_rows(61, hr=lambda i: 70.0 if i == 0 else None)
    assert features(spark, sparse, RunParams(clean=CleanParams(hr_fill_rows=10)))[0].reason == "insufficient_heart_rate"
    assert features(spark, sparse)[0].reason is None


def brute(rows):
    """The features of one window, value by value."""
    hr = np.array([r[7] for r in rows if r[7] is not None])
    minutes = np.array([(r[6] - rows[0][6]).total_seconds() / 60 for r in rows if r[7] is not None])
    beats = np.array([x for r in rows for x in r[8]])
    beats = beats[(beats >= 250) & (beats <= 2000)]
    steps = np.diff(beats)
    temp = np.array([r[9] for r in rows if r[9] is not None])
    q = [r[10] for r in rows]
    return {
        "hr_mean": hr.mean(), "hr_std": hr.std(ddof=1), "hr_min": hr.min(), "hr_max": hr.max(), "hr_slope_bpm_per_min": np.polyfit(minutes, hr, 1)[0],
        "hrv_rmssd": np.sqrt(np.mean(steps ** 2)), "hrv_sdnn": beats.std(ddof=1), "hrv_pnn50": np.mean(np.abs(steps) > 50) * 100,
        "ibi_available": 1.0, "ibi_coverage_ratio": np.mean([len(r[8]) > 0 for r in rows]), "skin_temp_mean": temp.mean(), "skin_temp_std": temp.std(ddof=1),
        "quality_good_ratio": q.count("good") / len(q), "quality_fair_ratio": q.count("fair") / len(q), "quality_poor_ratio": q.count("poor") / len(q),
        "valid_sample_ratio": np.mean([r[7] is not None and r[10] != "poor" for r in rows]), "sample_count": len(rows),
        "window_duration_seconds": (rows[-1][6] - rows[0][6]).total_seconds()}


def test_features_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    beats = [[float(x) for x in rng.integers(200, 2100, rng.integers(0, 4))] for _ in range(200)]
    hr = [float(x) for x in rng.normal(80, 9, 200)]
    rows = sample_rows(200, hr=lambda i: hr[i], ibi=lambda i: beats[i], temp=lambda i: 30 + hr[i] / 50, quality=lambda i: ["good", "fair", "poor", "unknown"][i % 4])
    got = features(spark, rows)
    for k, row in got.items():
        want = brute(rows[30 * k:30 * k + 60])
        for name, value in want.items():
            assert row[name] == pytest.approx(value, rel=1e-9, abs=1e-9), (k, name)
    whole = session_features(samples(spark, rows), ALL, as_of=at()).first()
    for name, value in brute(rows).items():
        assert whole[name] == pytest.approx(value, rel=1e-6), name


def test_single_and_missing_values(spark):
    one = features(spark, sample_rows(20, hr=lambda i: 70.0 if i == 19 else None, ibi=lambda i: [700.0, 710.0] if i == 3 else [], temp=lambda i: None),
                   RunParams(window=WindowParams(min_hr_ratio=0.0), features=FeatureToggles.all_on()))[0]
    assert (one.hr_mean, one.hr_std, one.hr_slope_bpm_per_min) == (70.0, 0.0, 0.0)
    assert (one.hrv_rmssd, one.hrv_sdnn, one.skin_temp_mean, one.skin_temp_std) == (None, None, None, None)
    assert one.ibi_available == 1.0 and one.ibi_coverage_ratio == 0.05
    none = features(spark, sample_rows(20, hr=lambda i: None, ibi=lambda i: []), RunParams(window=WindowParams(min_hr_ratio=0.0)))[0]
    assert (none.hr_mean, none.hr_std, none.hr_slope_bpm_per_min, none.ibi_available, none.valid_sample_ratio) == (None, None, None, 0.0, 0.0)


def test_toggles_choose_columns_and_infinities_vanish(spark):
    s = cl.link_ibi(samples(spark, sample_rows(20)))
    out = window_features(s, ["session_id"], FeatureToggles(hr_mean=False, hrv_pnn50=True), anchor=None)
    assert "hr_mean" not in out.columns and out.columns.index("hrv_pnn50") == out.columns.index("hrv_sdnn") + 1
    df = spark.createDataFrame([(float("inf"), float("nan"), 1.0)], "a double, b double, c double")
    assert tuple(finite_or_null(df).first()) == (None, None, 1.0)


def event(spark, at, user="u", session="s", device="d"):
    return spark.createDataFrame([("e", session, device, user, at)], "event_id string, session_id string, device_id string, user_id string, detected_at timestamp")


def test_event_window_is_closed(spark):
    offsets = [-60.0, -30.0, 0.0, 0.001, 30.0, -60.001]
    rows = [(*r[:6], T0 + timedelta(seconds=o), *r[7:]) for r, o in zip(sample_rows(6), offsets)]
    got = wn.event_windows(samples(spark, rows), event(spark, T0))
    assert sorted(r.pos for r in got.collect()) == [0, 1, 2]


@pytest.mark.parametrize("user, session, device, n", [("u", "s", "d", 60), (None, "s", "d", 60), ("x", "s", "d", 0), ("u", "t", "d", 0), ("u", "s", "x", 0)])
def test_event_window_scope(spark, user, session, device, n):
    got = wn.event_windows(samples(spark, sample_rows(60)), event(spark, T0 + timedelta(seconds=59), user, session, device))
    assert got.count() == n


def test_event_gate_reasons(spark):
    at = T0 + timedelta(seconds=59)
    def reason(rows, params=EventWindowParams()):
        e = event(spark, at)
        return wn.event_window_gate(e, wn.event_windows(samples(spark, rows), e, params), params).first().reason
    assert reason(sample_rows(60)) is None
    assert reason(sample_rows(9)) == "insufficient_samples"
    assert reason(sample_rows(15, hr=lambda i: 70.0 if i < 3 else None)) == "insufficient_samples"
    assert reason(sample_rows(5, session="other")) == "missing_telemetry"
    early = sample_rows(30, start=at - timedelta(seconds=100))
    assert reason(early) == "missing_telemetry"
    assert reason(early, EventWindowParams(size_seconds=90)) is None
