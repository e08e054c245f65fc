"""Splitting hot keys must never change a result."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseframe import fixtures as fx
from pulseframe.functions.quantiles import distribution
from pulseframe.functions.scale import hot_keys, number_rows, ordered, running_totals, split_hot
from pulseframe.operators import clean as cl
from pulseframe.operators import validate, windows
from pulseframe.params import CleanParams, FeatureToggles, RunParams, ScaleParams
from pulseframe.plans.ground_truth import build_ground_truth, event_features
from pulseframe.plans.windows import session_features, sliding_features

TINY = ScaleParams(max_rows_per_task=20, broadcast_rows=3)
WIDE = ScaleParams(max_rows_per_task=10**9)


def frame(df, *keys):
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)


def same(a, b, *keys):
    a, b = frame(a, *keys), frame(b, *keys)
    pd.testing.assert_frame_equal(a[sorted(a)], b[sorted(b)], rtol=1e-9, check_like=True)


def test_hot_keys_found(spark, sf):
    s = fx.samples(spark, sf)
    assert hot_keys(s, ["session_id"], WIDE) is None
    hot = hot_keys(s, ["session_id"], TINY)
    assert hot.keys == 15 and hot.rows == 1000


def test_number_rows_is_exact(spark):
    # One key holds almost everything, and many rows share one timestamp.
    df = spark.range(5000).select(F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("k"), (F.col("id") / 100).cast("int").alias("t"), "id")
    got = number_rows(df, ["k"], ["t"], 7, 2, TINY).toPandas()
    for _, part in got.groupby("k"):
        part = part.sort_values("__rn")
        assert list(part["__rn"]) == list(range(len(part)))
        assert part["t"].is_monotonic_increasing


@pytest.mark.parametrize("params", [CleanParams(), CleanParams(hr_fill_rows=3, temp_fill_rows=6, outlier_sigma=1.5)])
def test_clean_is_the_same_when_split(spark, sf, params):
    s = fx.gappy_samples(spark, sf).withColumn("heart_rate_bpm", F.when(F.col("pos") % 4 != 0, F.col("heart_rate_bpm")))
    same(cl.clean(s, params, scale=TINY).drop("ibi_ms", "ibi", "ibi_prev"), cl.clean(s, params, scale=WIDE).drop("ibi_ms", "ibi", "ibi_prev"), "session_id", "batch_id", "pos")


def test_windows_are_the_same_when_split(spark, sf):
    s = fx.gappy_samples(spark, sf)
    params = RunParams(window=fx.WINDOW, clean=CleanParams(hr_fill_rows=2), features=FeatureToggles(hrv_pnn50=True))
    same(sliding_features(s, params, TINY), sliding_features(s, params, WIDE), "session_id", "window_index")
    same(session_features(s, params, TINY), session_features(s, params, WIDE), "session_id")


def test_only_some_keys_are_hot(spark, sf):
    s = fx.samples(spark, sf).withColumn("session_id", F.when(F.col("session_id").cast("int") < 6, "big").otherwise(F.col("session_id")))
    some = ScaleParams(max_rows_per_task=150)
    assert hot_keys(s, ["session_id"], some).keys == 1
    params = RunParams(window=fx.WINDOW)
    same(sliding_features(s, params, some), sliding_features(s, params, WIDE), "session_id", "window_index")


def test_events_are_the_same_when_split(spark, sf):
    s, dec = fx.samples(spark, sf), fx.decisions(spark, sf).dropDuplicates(["event_id"])
    params = RunParams(event_window=fx.EVENT_WINDOW, features=FeatureToggles.all_on())
    at = F.lit("2024-03-01").cast("timestamp")
    tiny = ScaleParams(max_rows_per_task=12)
    same(event_features(s, dec, params, tiny, at), event_features(s, dec, params, WIDE, at), "event_id")


def test_order_checks_are_the_same_when_split(spark, sf):
    s = fx.samples(spark, sf).withColumn("sequence", F.col("sequence") - (F.col("pos") % 40 == 0).cast("int"))
    same(validate.backward_steps(s, scale=TINY), validate.backward_steps(s, scale=WIDE), "key")


def test_bucketed_event_join_equals_plain_join(spark, sf):
    s, dec = fx.samples(spark, sf), fx.decisions(spark, sf).dropDuplicates(["event_id"])
    e = dec.select("event_id", F.col("session_id").alias("es"), F.col("device_id").alias("ed"), F.col("detected_at").alias("t"))
    plain = s.join(e, (s.session_id == e.es) & (s.device_id == e.ed) & (s.timestamp <= e.t) & (s.timestamp >= e.t - F.expr("INTERVAL 7 DAYS")))
    got = windows.event_windows(s, dec, fx.EVENT_WINDOW)
    same(got.select("event_id", "pos"), plain.select("event_id", "pos"), "event_id", "pos")


def test_running_totals(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 400, p=[0.8, 0.1, 0.1]), "x": rng.permutation(400).astype(float), "n": rng.integers(0, 5, 400)})
    got = running_totals(spark.createDataFrame(pdf, "g string, x double, n long"), ["g"], ["x"], ["n"]).toPandas().sort_values("x")
    want = pdf.sort_values("x")
    want["before"] = want.groupby("g", dropna=False)["n"].cumsum() - want["n"]
    assert list(got["before_n"]) == list(want["before"])
    whole = running_totals(spark.createDataFrame(pdf[["x", "n"]], "x double, n long"), [], ["x"], ["n"]).toPandas().sort_values("x")
    assert list(whole["before_n"]) == list(want["n"].cumsum() - want["n"])


def test_distribution_equals_numpy(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 501, p=[0.9, 0.1]), "v": np.round(rng.normal(50, 9, 501), 1)})
    got = distribution(spark.createDataFrame(pdf), ["g"], "v", {"p25": 0.25, "p50": 0.5, "p90": 0.9}).toPandas().set_index("g")
    for g, v in pdf.groupby("g")["v"]:
        want = [len(v), v.mean(), v.std(), v.min(), *np.quantile(v, [0.25, 0.5, 0.9]), v.max()]
        np.testing.assert_allclose(got.loc[g].to_numpy(dtype=float), want, rtol=1e-12)


def test_carry_crosses_many_chunks(spark):
    rows = [("k", i, float(i) if i in (3, 170) else None) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    for scale in (TINY, WIDE):
        out = ordered(df, ["k"], ["i"], carried={"now": (F.col("v"), True), "before": (F.col("v"), False)}, scale=scale).toPandas().set_index("i")
        assert pd.isna(out.loc[2, "now"]) and out.loc[3, "now"] == 3 and pd.isna(out.loc[3, "before"])
        assert out.loc[169, "now"] == 3 and out.loc[170, "before"] == 3 and out.loc[399, "before"] == 170


def test_ground_truth_is_the_same_when_split(spark, sf):
    params = RunParams(event_window=fx.EVENT_WINDOW)
    args = fx.samples(spark, sf), fx.suspected(spark, sf), fx.decisions(spark, sf), params
    a = build_ground_truth(*args, scale=ScaleParams(max_rows_per_task=15), materialize=True)
    b = build_ground_truth(*args, materialize=True)
    same(a.exclusions, b.exclusions, "doc_id", "kind", "reason")
    same(a.dataset.select("event_id", *b.features), b.dataset.select("event_id", *b.features), "event_id")


def test_a_null_key_can_be_hot(spark):
    """Half of the rows have no session: they are split like any other hot key and get the same values."""
    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 10).cast("string").alias("k"),
                                 F.col("id").alias("t"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"))
    hot = hot_keys(df, ["k"], TINY)
    cold_rows, hot_rows = split_hot(df, ["k"], hot, TINY)
    assert hot_rows.filter("k IS NULL").count() == 200 and cold_rows.filter("k IS NULL").count() == 0
    assert number_rows(hot_rows, ["k"], ["t"], 5, hot.keys, TINY).filter("k IS NULL").agg(F.max("__rn")).first()[0] == 199

    def lagged(scale):
        return ordered(df, ["k"], ["t"], lambda d, w: d.withColumn("p", F.lag("t").over(w)), before=1, carried={"last": (F.col("v"), True)}, scale=scale)

    same(lagged(TINY), lagged(WIDE), "t")
