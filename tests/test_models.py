import math
from datetime import timedelta
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseframe import fixtures as fx
from pulseframe.operators import classifiers as clf
from pulseframe.operators import metrics as mt
from pulseframe.operators import prep, split
from pulseframe.operators.flatten import unflatten
from pulseframe.params import FALLBACK_METRICS, DummyParams, EventWindowParams, LogisticParams, RunParams, ScaleParams, SplitParams, WindowParams
from pulseframe.plans import scoring
from pulseframe.plans.ground_truth import build_ground_truth, event_features
from pulseframe.plans.training import select_variant, train_protocol
from pulseframe.schemas import FEATURE_SCHEMA
from pulseframe.session import cut_lineage
from pulseframe.sources.models import ModelError, SavedModel, load_model, save_model
from tests.helpers import T0, sample_rows, samples

PARAMS = RunParams(window=fx.WINDOW, event_window=fx.EVENT_WINDOW)


@pytest.fixture(scope="module")
def ds(spark):
    d = "/root/testdata/sf0.01"
    return cut_lineage(build_ground_truth(fx.samples(spark, d), fx.suspected(spark, d), fx.decisions(spark, d), PARAMS).dataset)


@pytest.fixture(scope="module")
def result(spark, ds, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    return train_protocol(ds, PARAMS, output=path), path


def scored(spark, y, p, s=None):
    rows = [(int(a), int(b), float(c)) for a, b, c in zip(y, p, s if s is not None else p)]
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_metrics_by_hand(spark):
    r = mt.evaluate(scored(spark, [0, 0, 0, 0, 1, 1, 1, 1], [0, 0, 0, 1, 0, 1, 1, 1])).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (3, 1, 1, 3)
    assert (r.accuracy, r.precision, r.recall, r.f1, r.specificity, r.false_positive_rate, r.balanced_accuracy) == (0.75,) * 5 + (0.25, 0.75)


def test_undefined_metrics_are_unavailable(spark):
    r = mt.evaluate(scored(spark, [1, 1, 1, 1], [1, 0, 1, 1])).first()
    assert r.available == {"accuracy": True, "precision": True, "recall": True, "f1": True, "roc_auc": False, "average_precision": False,
                           "balanced_accuracy": False, "specificity": False, "false_positive_rate": False}
    assert r.roc_auc is None and r.specificity is None
    none = mt.evaluate(scored(spark, [0, 1], [0, 0])).first()
    assert none.precision is None and none.f1 is None and none.recall == 0.0
    short = mt.evaluate(scored(spark, [0, 1], [0, 1]), params=mt.configured(None)).first()
    assert set(short.available) == set(FALLBACK_METRICS)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_equals_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    y, s = rng.integers(0, 2, 150), np.round(rng.random(150), 1)
    r = mt.evaluate(scored(spark, y, s > 0.5, s)).first()
    pos, neg = s[y == 1], s[y == 0]
    pairs = (pos[:, None] > neg[None]).mean() + (pos[:, None] == neg[None]).mean() / 2
    assert r.roc_auc == pytest.approx(pairs, abs=1e-12)
    cuts = sorted(set(s), reverse=True)
    tp = [((s >= c) & (y == 1)).sum() for c in cuts]
    all_ = [(s >= c).sum() for c in cuts]
    ap = sum((t - u) / y.sum() * t / n for t, u, n in zip(tp, [0, *tp], all_))
    assert r.average_precision == pytest.approx(ap, abs=1e-12)
    best = mt.best_f1_threshold(mt.ranked_scores(scored(spark, y, s > 0.5, s))).first()
    f1 = {c: 2 * t / (n + y.sum()) for c, t, n in zip(cuts, tp, all_)}
    assert best.threshold == min(c for c in cuts if f1[c] == pytest.approx(max(f1.values()), abs=1e-9))


def test_threshold_ties_go_low(spark):
    df = scored(spark, [1, 0, 0, 1], [0] * 4, [0.9, 0.8, 0.7, 0.6])
    assert mt.best_f1_threshold(mt.ranked_scores(df)).first().threshold == 0.6


def test_threshold_source(spark):
    both, single = [0, 1], [1, 1]
    def source(train, val):
        rows = [("train", y, 0.5) for y in train] + [("val", y, 0.6) for y in val] + [("test", 0, 0.1), ("test", 1, 0.9)]
        found, where = mt.select_threshold(spark.createDataFrame(rows, "split string, label int, score double"))
        return found.first().threshold, where
    assert source(both, both) == (0.6, "val") and source(both, single) == (0.5, "train") and source(single, single) == (0.5, "val")


def test_missing_split_gives_nulls(spark):
    df = scored(spark, [0, 1], [0, 1]).withColumn("split", F.lit("train"))
    got = {r.split: r.n_samples for r in mt.evaluate_splits(df).collect()}
    assert got == {"train": 2, "val": None, "test": None}


def test_split_sizes_and_isolation(spark, ds):
    s = split.fit_group_split(ds, SplitParams(), "user_id")
    assert (s.n_groups, s.n_test, s.n_val) == (50, 10, 5)
    rows = s.assign(ds)
    assert {r.pair: r.n_common for r in split.group_overlap(rows).collect()} == {"train_vs_val": 0, "train_vs_test": 0, "val_vs_test": 0}
    assert {r.split: r.n_groups for r in split.split_report(rows).collect()} == {"train": 35, "val": 5, "test": 10}
    again = split.fit_group_split(ds.orderBy(F.rand(3)).repartition(3), SplitParams(), "user_id")
    assert again == s and split.fit_group_split(ds, SplitParams(seed=7), "user_id") != s
    with pytest.raises(ValueError):
        split.split_sizes(1, 0.2, 0.1)


def newton(x, y, w, c):
    """L2 logistic regression with a free intercept, solved directly."""
    x = np.hstack([x, np.ones((len(x), 1))])
    b, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) / c
    ridge[-1, -1] = 0
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        g, h = x.T @ (w * (p - y)) + ridge @ b, (x * (w * p * (1 - p))[:, None]).T @ x + ridge
        b = b - np.linalg.solve(h, g)
    return b


@pytest.mark.parametrize("weight", [None, "balanced"])
def test_logistic_equals_newton(spark, ds, weight):
    stats = prep.fit_prep(ds)
    model = clf.fit_logistic(ds, stats, LogisticParams(C=0.5, class_weight=weight))
    pdf = prep.apply_prep(ds, stats).select(*stats.outputs(), F.col("target_support_requested").alias("y")).toPandas()
    x, y = pdf[stats.outputs()].to_numpy(), pdf["y"].to_numpy()
    n = {c: (y == c).sum() for c in (0, 1)}
    w = np.where(y == 1, len(y) / 2 / n[1], len(y) / 2 / n[0]) if weight else np.ones(len(y))
    want = newton(x, y, w, 0.5)
    lr = model.stages.stages[-1]
    np.testing.assert_allclose([*lr.coefficients, lr.intercept], want, atol=2e-4)


def test_prep_rules(spark):
    df = spark.createDataFrame([(1.0, None, 5.0, None), (2.0, None, 5.0, 0.5), (float("inf"), None, 5.0, 0.25), (4.0, None, 5.0, None)],
                               "hr_mean double, hr_std double, hr_min double, ibi_coverage_ratio double")
    stats = prep.fit_prep(df)
    assert stats.features == ("hr_mean", "hr_min", "ibi_coverage_ratio")  # nothing observed: dropped
    assert stats.fills == {"hr_mean": 2.0, "hr_min": 5.0, "ibi_coverage_ratio": 0.0}
    assert stats.scales["hr_min"] == 1.0 and stats.inputs()[-1] == "ibi_coverage_ratio_was_nan"
    out = prep.apply_prep(df, stats).toPandas()
    filled = np.array([1.0, 2.0, 2.0, 4.0])
    np.testing.assert_allclose(out["z_hr_mean"], (filled - filled.mean()) / filled.std())
    assert prep.PrepStats.from_dict(stats.to_dict()) == stats
    with pytest.raises(ValueError, match="hr_mean"):
        prep.apply_prep(df.drop("hr_mean"), stats)
    with pytest.raises(ValueError):
        prep.select_features(df.select("hr_std"))


def test_baselines(spark, ds):
    def run(strategy, constant=0):
        return clf.predict(ds, clf.fit_dummy(ds, FEATURE_SCHEMA, DummyParams(strategy, constant)))
    prior = ds.agg(F.avg("target_support_requested")).first()[0]
    assert run("prior").agg(F.min("probability"), F.max("probability"), F.max("prediction")).first()[:] == (prior, prior, int(prior > 0.5))
    assert run("constant", 1).agg(F.min("prediction")).first()[0] == 1
    share = run("stratified").agg(F.avg("prediction")).first()[0]
    assert abs(share - prior) < 0.1 and abs(run("uniform").agg(F.avg("prediction")).first()[0] - 0.5) < 0.1


def test_single_class_is_refused(spark, ds):
    one = ds.filter("target_support_requested = 0")
    with pytest.raises(ValueError):
        clf.fit_logistic(one, prep.fit_prep(one))


def test_protocol(spark, result):
    r, _ = result
    assert r.metrics.count() == 9 and set(r.thresholds) == {"unweighted", "balanced"} and r.threshold_source in ("val", "train")
    f1 = {x.model: x.f1 for x in r.selection.collect()}
    assert r.selected == select_variant(f1["unweighted"], f1["balanced"])
    assert {x.n_common for x in r.overlap().collect()} == {0}
    assert select_variant(0.5, 0.5) == "unweighted" and select_variant(None, 0.9) == "unweighted" and select_variant(0.4, 0.5) == "balanced"
    assert r.test.count() == 2 and {x.n_samples for x in r.test.collect()} == {x.n_rows for x in r.split_counts().filter("split = 'test'").collect()}


def test_only_train_rows_are_learned_from(spark, ds, result):
    r, _ = result
    moved = r.split.assign(ds).withColumn("hr_mean", F.when(F.col("split") == "train", F.col("hr_mean")).otherwise(F.col("hr_mean") * 100)).drop("split")
    other = train_protocol(moved, PARAMS)
    assert other.prep == r.prep
    a, b = (x.models["unweighted"].stages.stages[-1] for x in (r, other))
    np.testing.assert_allclose(a.coefficients, b.coefficients, atol=1e-9)


def test_saved_model(spark, ds, result, tmp_path):
    r, path = result
    text = b"".join(p.read_bytes() for p in Path(path).rglob("*") if p.is_file())
    known = [x.event_id for x in ds.filter("length(event_id) = 5").limit(20).select("event_id").collect()]
    assert b"session_id" not in text and not any(f'"{k}"'.encode() in text for k in known)
    loaded = load_model(spark, path)
    assert (loaded.threshold, loaded.threshold_source, loaded.params) == (r.saved.threshold, r.threshold_source, r.saved.params)
    a = clf.predict(ds, loaded.classifier).select("event_id", "probability").toPandas().sort_values("event_id")
    b = clf.predict(ds, r.saved.classifier).select("event_id", "probability").toPandas().sort_values("event_id")
    np.testing.assert_array_equal(a["probability"], b["probability"])
    spark.createDataFrame([('{"artifact_type": "other"}',)], "value string").write.text(f"{tmp_path}/m/metadata")
    with pytest.raises(ModelError):
        load_model(spark, f"{tmp_path}/m")
    with pytest.raises(ModelError):
        SavedModel(r.saved.classifier, "1", "t", 0.5, "val", ("a", "a"))


def requests(spark, rows, at):
    docs = unflatten(samples(spark, rows))
    return docs.select(F.lit("e").alias("event_id"), "device_id", "user_id", "session_id", F.lit(at).alias("detected_at"), "samples")


def test_request_features_equal_offline(spark):
    rng = np.random.default_rng(3)
    hr = [None if rng.random() < 0.2 else float(x) for x in rng.normal(75, 6, 900)]
    rows = sample_rows(900, hr=lambda i: hr[i], ibi=lambda i: [700.0 + i % 90] if i % 3 else [])
    at = T0 + timedelta(seconds=500)
    online = scoring.request_features(requests(spark, rows, at)).first()
    event = spark.createDataFrame([("e", "s", "d", "u", at)], "event_id string, session_id string, device_id string, user_id string, detected_at timestamp")
    offline = event_features(samples(spark, rows), event).first()
    assert online.sample_count == 61
    for f in FEATURE_SCHEMA:
        assert online[f] == pytest.approx(offline[f], abs=1e-9)


def test_request_gates_follow_stored_parameters(spark):
    at = T0 + timedelta(seconds=100)
    early = sample_rows(30)
    wide = RunParams(event_window=EventWindowParams(size_seconds=90, min_samples=20))
    assert scoring.request_features(requests(spark, early, at)).first().reason == "missing_telemetry"
    got = scoring.request_features(requests(spark, early, at), wide).first()
    assert (got.reason, got.sample_count) == (None, 20)
    few = sample_rows(15, start=at - timedelta(seconds=20), hr=lambda i: 70.0 if i < 3 else None)
    assert scoring.request_features(requests(spark, few, at)).first().reason == "insufficient_samples"
    assert EventWindowParams.inherit(WindowParams(size_seconds=90, min_samples=20)) == EventWindowParams(90, 20, 0.3)


def test_score_features(spark, ds, result):
    r, _ = result
    x = ds.select("event_id", *FEATURE_SCHEMA)
    scores, bad = scoring.score_features(x, r.saved)
    p = scores.toPandas()
    assert bad.isEmpty() and ((p["support_probability"] >= r.saved.threshold) == (p["prediction"] == 1)).all() and len(p) == ds.count()
    inf = x.withColumn("hr_max", F.lit(math.inf))
    assert scoring.score_features(inf, r.saved)[0].isEmpty() and {b.infinite_features for b in scoring.score_features(inf, r.saved)[1].collect()} == {"hr_max"}
    missing = x.withColumn("hrv_rmssd", F.lit(None).cast("double")).withColumn("hr_mean", F.lit(math.nan))
    assert scoring.score_features(missing, r.saved)[0].count() == ds.count()
    for wrong in (x.drop("hr_mean"), x.withColumn("detector_score", F.lit(1.0))):
        with pytest.raises(scoring.ScoringError):
            scoring.score_features(wrong, r.saved)


def test_score_tables(spark, sf, result):
    r, _ = result
    batches = scoring.score_batches(fx.batches(spark, sf), r.saved)
    assert batches.count() == 100
    labels = batches.select("session_id", "window_index", F.lit(1).alias("label"))
    assert scoring.scored_metrics(batches, labels, ["session_id", "window_index"]).first().n_positive == 100
    with pytest.raises(scoring.ScoringError):
        scoring.scored_metrics(batches, labels.limit(50), ["session_id", "window_index"])
    s = fx.samples(spark, sf)
    assert scoring.score_samples(s, r.saved).count() == 15
    with pytest.raises(scoring.ScoringError, match="null_values"):
        scoring.score_samples(s.withColumn("user_id", F.when(F.col("pos") > 9, F.col("user_id"))), r.saved)


def test_params_round_trip():
    p = RunParams(window=WindowParams(90, 45), event_window=EventWindowParams(30), logistic=LogisticParams(2.0))
    assert RunParams.from_dict(p.to_dict()) == p


def test_scoring_builds_the_dataset_once(spark, sf, monkeypatch):
    """``score_features`` trains and scores on one stored dataset."""
    from pulseframe.catalog import labelling, modelling

    built, build = [], labelling.build_ground_truth
    monkeypatch.setattr(labelling, "build_ground_truth", lambda *a, **k: (built.append(k.get("materialize")), build(*a, **k))[1])
    given = []
    monkeypatch.setattr(modelling, "_model", lambda spark, sf_dir, ds=None: given.append(ds))
    monkeypatch.setattr(modelling.scoring, "score_features", lambda features, model: (features, model))
    assert modelling._score_features(spark, sf).columns[0] == "event_id"
    assert built == [True] and given[0] is not None
