"""Sliding windows by panes against a row for every window and sample."""

import random
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseframe.operators import clean as cl
from pulseframe.operators.window_panes import pane_aggregates, pane_size, sliding_pane_features
from pulseframe.operators.windows import sliding_windows
from pulseframe.params import CleanParams, FeatureToggles, RunParams, ScaleParams, WindowParams
from pulseframe.plans.windows import sliding_features
from tests.helpers import T0, sample_rows, samples

TINY = ScaleParams(max_rows_per_task=40, broadcast_rows=5)


def uneven(n, session, step, seed, start=T0):
    r = random.Random(seed)
    rows = sample_rows(n, session=session, start=start, step=step, hr=lambda i: None if i % 29 < 11 else 60.0 + r.random() * 30,
                       ibi=lambda i: [] if i % 3 == 0 else [r.choice([180.0, 700.0, 790.5, 860.0]) for _ in range(i % 4)],
                       quality=lambda i: None if i < 7 else r.choice(["good", "fair", "poor", "unknown"]), temp=lambda i: 33.0 + r.random() if i % 40 == 0 else None)
    return rows + [row[:5] + (1000 + row[5],) + row[6:] for row in rows[::13]]


def rows(spark):
    """Long, short, one-instant, small and interrupted sessions, and one that is a window long to the microsecond."""
    gap = T0 + timedelta(hours=3)
    return samples(spark, uneven(500, "long", 1.0, 1) + uneven(40, "short", 1.0, 2) + sample_rows(12, session="instant", step=0.0) + uneven(6, "few", 1.0, 3)
                   + uneven(150, "gap", 0.7, 4) + uneven(90, "gap", 0.7, 5, gap) + uneven(61, "exact", 1.0, 6)
                   + uneven(200, "sparse", 17.0, 7, T0 + timedelta(microseconds=7)) + sample_rows(70, session="flat", hr=lambda i: 71.25, temp=lambda i: 33.3))


def table(df):
    got = df.toPandas().sort_values(["session_id", "window_index"]).reset_index(drop=True)
    return got[sorted(got)]


@pytest.mark.parametrize("size,stride", [(60.0, 30.0), (60.0, 1.0), (60.0, 60.0), (60.0, 25.0), (20.0, 50.0), (0.9, 0.6)])
@pytest.mark.parametrize("scale", [ScaleParams(), TINY])
def test_equal_to_windows_of_samples(spark, size, stride, scale):
    params = RunParams(window=WindowParams(size, stride, 10, 0.3), clean=CleanParams(hr_fill_rows=5, temp_fill_rows=30), features=FeatureToggles.all_on())
    now = F.lit("2026-02-01").cast("timestamp")
    got = table(sliding_pane_features(rows(spark), params, scale, as_of=now))
    want = table(sliding_features(rows(spark), params, as_of=now))
    pd.testing.assert_frame_equal(got, want, rtol=1e-8, atol=1e-8, check_dtype=False)
    assert len(got)


def test_rows_fall_to_panes_when_windows_overlap_much(spark):
    """Windows of 60 strides: a sample would be copied up to 60 times, a pane is there once."""
    params = WindowParams(60.0, 1.0, 10, 0.0)
    s = cl.clean(samples(spark, sample_rows(3000, step=0.1)))
    copies, panes = sliding_windows(s, params).count(), pane_aggregates(s, params).count()
    assert pane_size(params) == 1_000_000 and panes == 300 and copies > 40 * 3000


def test_an_empty_table_gives_no_window(spark):
    assert sliding_pane_features(samples(spark, [])).count() == 0
