"""Quantiles and split bounds by counting equal sorting, on values that are awkward to bin."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseframe.functions.quantiles import coarse_bin, distribution
from pulseframe.operators.split import draws_at
from pulseframe.params import ScaleParams

PROBS = {"p00": 0.0, "p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
# Small bins and nothing gathered, so that brackets are cut many times over.
NARROW = ScaleParams(quantile_bins=3, quantile_gather=1)


def _groups():
    rng = np.random.default_rng(11)
    return {
        "normal": rng.normal(70, 12, 900),
        "both_signs": rng.normal(0, 1, 701),
        "tied": rng.choice([0.1, 0.2, 0.30000000000000004], 500),
        "wide": np.concatenate([10.0 ** rng.uniform(-300, 300, 200), -(10.0 ** rng.uniform(-300, 300, 100))]),
        "close": 1.0 + np.arange(300) * 2.0 ** -52,
        "tiny": np.arange(-40, 60) * 5e-324,
        "zeros": np.array([0.0, -0.0, 0.0, -1.0]),
        "one": np.array([3.5]),
        "clusters": np.concatenate([[1.0], 1.03 + np.arange(200) * 1e-13]),
    }


@pytest.mark.parametrize("scale", [ScaleParams(), NARROW, ScaleParams(quantile_bins=64, quantile_gather=2, broadcast_rows=0)])
def test_quantiles_equal_sorting(spark, scale):
    groups = _groups()
    rows = pd.DataFrame({"g": [g for g, v in groups.items() for _ in v], "v": np.concatenate(list(groups.values()))})
    df = spark.createDataFrame(rows).unionByName(spark.createDataFrame([(None, 2.0), (None, 4.0), ("none", None)], "g string, v double"))
    got = distribution(df.repartition(5), ["g"], "v", PROBS, scale).toPandas().set_index("g")
    assert "none" not in got.index and len(got) == len(groups) + 1
    for g, v in groups.items():
        ordered = np.sort(v)
        for name, p in PROBS.items():
            at = p * (len(v) - 1)
            low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            assert got.loc[g, name] == low + (high - low) * (at - np.floor(at)), (g, name)
        assert got.loc[g, "count"] == len(v) and got.loc[g, "min"] == v.min() and got.loc[g, "max"] == v.max()
        if g not in ("wide", "tiny"):
            np.testing.assert_allclose(got.loc[g, "mean"], v.mean(), rtol=1e-9, atol=1e-12)
            if len(v) > 1 and g != "close":  # there the rounding of the mean is a percent of the deviation
                np.testing.assert_allclose(got.loc[g, "std"], v.std(ddof=1), rtol=1e-9)
    null = got[got.index.isna()].iloc[0]
    assert null["count"] == 2 and null["p50"] == 3.0


def test_infinite_and_missing_numbers_have_their_places(spark):
    rows = [("a", float(x)) for x in ("-inf", "1", "2", "inf", "nan")]
    got = distribution(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"p25": 0.25, "p50": 0.5}, NARROW).first()
    assert got["min"] == float("-inf") and got["p25"] == 1.0 and got["p50"] == 2.0 and np.isnan(got["max"])


def test_nothing_gives_no_row(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert distribution(empty, ["g"], "v", PROBS).count() == 0
    assert distribution(spark.createDataFrame([("a", None)], "g string, v double"), ["g"], "v", PROBS).count() == 0


def test_first_bins_never_fall(spark):
    values = np.sort(np.concatenate([_groups()["wide"], _groups()["tiny"], np.nextafter(2.0 ** np.arange(-50, 50), 0), 2.0 ** np.arange(-50, 50)]))
    df = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(values)], "i int, v double")
    bins = [r["b"] for r in df.select("i", coarse_bin(F.col("v")).alias("b")).orderBy("i").collect()]
    assert bins == sorted(bins)


def test_no_value_is_exchanged(spark):
    """A pass hands on counts: whatever is shuffled is grouped by bin, and no range partitioning is left."""
    df = spark.range(20_000).select(F.lit("a").alias("g"), F.rand(3).alias("v"))
    plan = distribution(df, ["g"], "v", {"p50": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("gather", [1, 5, 4096])
def test_draws_at_equal_sorting(spark, gather):
    draws = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(9_000))
    df = spark.createDataFrame([(d,) for d in draws], "draw string").repartition(4)
    ranks = [-1, 0, 17, 4_321, 4_322, 8_999, 9_000]
    assert draws_at(df, ranks, ScaleParams(quantile_gather=gather)) == {r: draws[r] for r in ranks if 0 <= r < 9_000}
    assert draws_at(df.limit(0), [0, 3]) == {}
