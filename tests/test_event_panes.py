"""Event windows from panes against the row-wise definition: join, clean and aggregate every window alone."""

import random
import re
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseframe.operators.clean import clean, with_ibi
from pulseframe.operators import event_panes
from pulseframe.operators.event_panes import chained, event_pane_features
from pulseframe.operators.features import window_features
from pulseframe.operators.windows import event_windows
from pulseframe.params import CleanParams, EventWindowParams, FeatureToggles, RunParams, ScaleParams
from tests.helpers import T0, sample_rows, samples

TINY = ScaleParams(max_rows_per_task=40, broadcast_rows=3)


def by_rows(s, events, params, as_of):
    windowed = with_ibi(event_windows(s, events, params.event_window)).withColumn("__has_hr", F.col("heart_rate_bpm").isNotNull())
    gate = [F.count(F.lit(1)).alias("n_samples"), F.avg(F.when(F.col("__has_hr"), 1.0).otherwise(0.0)).alias("hr_ratio")]
    cleaned = clean(windowed.drop("user_id", "batch_id"), params.clean, "event_id")
    return window_features(cleaned, ["event_id", "window_start"], params.features, as_of=as_of, extra=gate).drop("window_start")


def hostile(spark, seed):
    """Gaps, ties in time, nulls everywhere, two users in one session, two devices, and events with and without a user."""
    rng = random.Random(seed)
    rows = []
    for session in ("s", "t", "gap"):
        at = 0.0
        for i in range(220):
            at += rng.choice([0, 0, 0.5, 1, 2, 9] if session != "gap" else [1, 1, 1, 40])
            rows.append(("b", rng.choice(["u", "u", "v", None]), rng.choice(["d", "d", "d", "e"]), session, rng.randrange(2), i, T0 + timedelta(seconds=at),
                         rng.choice([None, None, None, 60.0 + rng.randrange(60), 72.5]), rng.choice([[], None, [100.0], [800.0], [600.0, 900.0, 2500.0], [700.0, 701.0]]),
                         rng.choice([None, None, 31.0 + rng.random()]), rng.choice([None, None, "good", "fair", "poor", "unknown"]), "good", "onBody"))
    rows += [(*r[:8], r[8], r[9], r[10], "good", "onBody") for r in sample_rows(30, session="flat", start=T0 - timedelta(seconds=7), hr=lambda i: 70.0, temp=lambda i: 33.3)]
    events = [(f"{session}{k}", session, rng.choice(["d", "d", "e"]), rng.choice(["u", "v", None]), T0 + timedelta(seconds=rng.choice([k * 3, k * 3 + 0.5])))
              for session in ("s", "t", "gap", "flat") for k in range(0, 220, 2)]
    events += [("none", "x", "d", "u", T0), ("null", None, "d", "u", T0), ("never", "s", "d", "u", None)]
    return samples(spark, rows), spark.createDataFrame(events, "event_id string, session_id string, device_id string, user_id string, detected_at timestamp")


@pytest.mark.parametrize("seed, size, scale", [(1, 30.0, ScaleParams()), (2, 7.0, ScaleParams()), (3, 45.0, TINY)])
def test_panes_equal_rows(spark, seed, size, scale):
    s, events = hostile(spark, seed)
    params = RunParams(event_window=EventWindowParams(size_seconds=size), clean=CleanParams(hr_fill_rows=3, temp_fill_rows=5), features=FeatureToggles.all_on())
    at = F.lit(T0 + timedelta(days=1))
    got, want = (f.toPandas().sort_values("event_id").reset_index(drop=True) for f in (event_pane_features(s, events, params, scale, at), by_rows(s, events, params, at)))
    assert list(got["event_id"]) == list(want["event_id"]) and len(got) > 100
    pd.testing.assert_frame_equal(got.astype({c: float for c in got if c != "event_id"}), want.astype({c: float for c in want if c != "event_id"}), rtol=1e-9, atol=1e-9)


def test_many_overlapping_events_make_no_pairs(spark):
    """10,000 events over one session of 2,000 samples: a sample stays one row."""
    s = samples(spark, sample_rows(2_000))
    events = spark.range(10_000).select(
        F.col("id").cast("string").alias("event_id"), F.lit("s").alias("session_id"), F.lit("d").alias("device_id"), F.lit("u").alias("user_id"),
        (F.lit(T0) + F.make_dt_interval(secs=F.col("id") % 2_000 + F.lit(0.5))).alias("detected_at"))
    params = RunParams(event_window=EventWindowParams(size_seconds=600.0))
    out = event_pane_features(s, events, params)
    got = out.agg(F.count(F.lit(1)).alias("n"), F.max("n_samples").alias("most")).first()
    assert (got["n"], got["most"]) == (10_000, 600)
    marked = events.select("event_id", "session_id", "device_id", F.col("user_id").alias("__user"), F.floor(F.unix_micros("detected_at") / 600_000_000).alias("__pane"))
    assert chained(s, marked, 600_000_000).count() <= 2_000
    assert np.isfinite(out.toPandas()["hr_mean"]).all()


def test_tasks_follow_the_rows_not_the_settings(spark, monkeypatch):
    """Each direction, and the join of both, is dealt over as many tasks as its rows need; results stay the same."""
    params = RunParams(event_window=EventWindowParams(15.0, 1, 0.0), features=FeatureToggles.all_on())
    s, events = hostile(spark, 11)
    want = event_pane_features(s, events, params, as_of=F.lit("2026-02-01").cast("timestamp"))
    monkeypatch.setattr(event_panes, "ROWS_PER_TASK", 25)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = event_pane_features(s, events, params, as_of=F.lit("2026-02-01").cast("timestamp"))
        n = events.filter("session_id IS NOT NULL AND detected_at IS NOT NULL").count()
        assert got.rdd.getNumPartitions() >= 2 * n // 25 > 10
        dealt = [int(x) for x in re.findall(r"hashpartitioning\(session_id\S*, device_id\S*, __user\S*, __pane\S*, (\d+)\)", got._jdf.queryExecution().executedPlan().toString())]
        assert len(dealt) >= 2 and min(dealt) > n // 25
        key = lambda r: (r.event_id, r.n_samples)
        pd.testing.assert_frame_equal(pd.DataFrame(sorted(got.collect(), key=key)), pd.DataFrame(sorted(want.collect(), key=key)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_windows_of_one_order_share_a_sort_and_no_frame_slides(spark):
    """Fills and running aggregates sort once for each of two directions; a sliding frame would read its rows again at every row."""
    s, events = hostile(spark, 5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = event_pane_features(s, events, RunParams(event_window=EventWindowParams(15.0, 1, 0.0)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Sort [session_id") == 4
    assert not re.search(r"specifiedwindowframe\(RowFrame, -\d+, currentrow", plan)


def test_registered_queries_leave_no_method_too_long_to_compile(spark):
    import __spark_entry__

    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        __spark_entry__._prepared(spark)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "9000")  # what the session sets wins
        __spark_entry__._prepared(spark)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.set(key, before)
