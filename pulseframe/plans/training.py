"""Training with one user-wise split: prior baseline, plain and balanced regression, choice on validation."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.classifiers import Classifier, fit_dummy, fit_logistic, predict
from pulseframe.operators.labels import TARGET
from pulseframe.operators.metrics import (
    evaluate, evaluate_splits, predict_at, ranked_scores, ranking_metrics, select_threshold,
)
from pulseframe.operators.prep import PrepStats, fit_prep
from pulseframe.operators.qa import require_ready
from pulseframe.operators.split import GROUP_COLUMNS, GroupSplit, fit_group_split, group_overlap, split_report
from pulseframe.params import MetricParams, ReadinessParams, RunParams, ScaleParams, SplitParams
from pulseframe.sources.models import SavedModel, save_model
from pulseframe.session import cut_lineage

# Names of the compared models and the default version tag.
BASELINE, PLAIN, BALANCED = "dummy", "unweighted", "balanced"
DEFAULT_MODEL_VERSION = "0.1.0"


@dataclass(frozen=True)
class TrainedSplit:
    """One classifier with its split; metrics per split come from :func:`evaluate_model`."""

    classifier: Classifier
    prep: PrepStats
    split: GroupSplit
    data: DataFrame


@dataclass(frozen=True)
class ProtocolResult:
    readiness: DataFrame
    split: GroupSplit
    data: DataFrame              # the dataset with its split column
    prep: PrepStats
    models: dict[str, Classifier]
    scored: DataFrame            # (model, event_id, split, label, score, prediction)
    metrics: DataFrame           # per model and split, at the classifier's own prediction
    thresholds: dict[str, float]
    threshold_source: str
    selection: DataFrame         # per regression, on the split the threshold came from, at that threshold
    test: DataFrame              # per regression, on test, at that threshold
    selected: str
    saved: SavedModel

    def split_counts(self) -> DataFrame:
        return split_report(self.data, self.split.group)

    def overlap(self) -> DataFrame:
        return group_overlap(self.data, self.split.group)


def select_variant(plain_f1: float | None, balanced_f1: float | None) -> str:
    """The balanced variant only when its F1 is known and strictly higher."""
    if plain_f1 is not None and balanced_f1 is not None and balanced_f1 > plain_f1:
        return BALANCED
    return PLAIN


def fit_classifier(train: DataFrame, prep: PrepStats, params: RunParams, model_type: str, label: str = TARGET) -> Classifier:
    """logistic_regression, dummy (configured strategy) or baseline (always the prior)."""
    if model_type == "logistic_regression":
        return fit_logistic(train, prep, params.logistic, label)
    dummy = params.dummy if model_type == "dummy" else replace(params.dummy, strategy="prior")
    return fit_dummy(train, prep.features, dummy, label)


def train_on_windows(windows: DataFrame, params: RunParams = RunParams(), model_type: str = "logistic_regression",
                     label: str = "label", features=None, scale: ScaleParams = ScaleParams()) -> TrainedSplit:
    """Train one classifier on labelled windows, split by the configured group."""
    names = list(features or params.features.names())
    windows = cut_lineage(windows)  # read by the split, every fit and the evaluation
    split = fit_group_split(windows, params.split, GROUP_COLUMNS[params.split.group_by], scale)
    data = split.assign(windows)
    train = data.filter(F.col("split") == "train")
    prep = fit_prep(train, names, scale)
    return TrainedSplit(fit_classifier(train, prep, params, model_type, label), prep, split, data)


def evaluate_model(trained: TrainedSplit, params: MetricParams = MetricParams(), label: str = "label",
                   key: str = "session_id", scale: ScaleParams = ScaleParams()) -> DataFrame:
    scored = predict(trained.data, trained.classifier, key).select("split", F.col(label).alias("label"), "probability", "prediction")
    return evaluate_splits(scored, (), params, "label", "prediction", "probability", scale)


def _values(df: DataFrame, value: str) -> dict[str, float | None]:
    return {r["model"]: r[value] for r in df.select("model", value).collect()}  # one row per model


def train_protocol(ds: DataFrame, params: RunParams = RunParams(), ready: ReadinessParams = ReadinessParams(),
                   output: str | None = None, model_version: str = DEFAULT_MODEL_VERSION, target: str = TARGET,
                   features=None, scale: ScaleParams = ScaleParams()) -> ProtocolResult:
    """Readiness, one split by user, three models, metrics, thresholds and the choice between the regressions.

    Everything fitted sees train rows only. Thresholds and the choice use validation (or train when validation
    has a single class); test rows are only evaluated.
    """
    ds = cut_lineage(ds)  # read by the checks, the split, every fit and the evaluation
    readiness = require_ready(ds, ready)
    names = list(features or params.features.names())
    by_user = SplitParams(params.split.test_size, params.split.val_size, "user", params.split.seed)
    split = fit_group_split(ds, by_user, "user_id", scale)
    data = split.assign(ds)
    train = data.filter(F.col("split") == "train")
    prep = fit_prep(train, names, scale)
    models = {
        BASELINE: fit_dummy(train, prep.features, params.dummy, TARGET),
        PLAIN: fit_logistic(train, prep, replace(params.logistic, class_weight=None), TARGET),
        BALANCED: fit_logistic(train, prep, replace(params.logistic, class_weight="balanced"), TARGET),
    }
    scored = None
    for name, model in models.items():
        part = predict(data.select("event_id", "split", TARGET, *prep.features), model).select(
            F.lit(name).alias("model"), "event_id", "split", F.col(TARGET).alias("label"),
            F.col("probability").alias("score"), "prediction")
        scored = part if scored is None else scored.unionByName(part)
    scored = cut_lineage(scored)

    # Ranking does not depend on a threshold: one ordering of the scores serves every report below.
    keys = ["model", "split"]
    ranked = ranked_scores(scored, keys, scale=scale)
    ranks = ranking_metrics(ranked, keys)
    metrics = evaluate_splits(scored, ["model"], params.metrics, scale=scale, ranks=ranks)
    regressions = scored.filter(F.col("model") != BASELINE)
    chosen, source = select_threshold(regressions, ["model"], scale=scale, ranked=ranked.filter(F.col("model") != BASELINE))
    thresholds = _values(chosen, "threshold")
    own = F.when(F.col("model") == PLAIN, thresholds[PLAIN]).otherwise(thresholds[BALANCED])
    at_threshold = evaluate(predict_at(regressions, own), keys, params.metrics, scale=scale, ranks=ranks).withColumn("threshold", own)
    selection, test = (at_threshold.filter(F.col("split") == name).drop("split") for name in (source, "test"))
    f1 = _values(selection, "f1") if "f1" in selection.columns else {}
    winner = select_variant(f1.get(PLAIN), f1.get(BALANCED))
    logistic = replace(params.logistic, class_weight=None if winner == PLAIN else "balanced")
    saved = SavedModel(models[winner], model_version, target, float(thresholds[winner]), source, tuple(names),
                       replace(params, logistic=logistic))
    if output is not None:
        save_model(ds.sparkSession, saved, output)
    return ProtocolResult(readiness, split, data, prep, models, scored, metrics, thresholds, source, selection,
                          test, winner, saved)
