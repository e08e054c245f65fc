"""Batch scoring of windows, flat samples, feature rows and event requests with a saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.columns import micros
from pulseframe.functions.scale import hot_keys
from pulseframe.operators.classifiers import predict
from pulseframe.operators.clean import clean
from pulseframe.operators.features import window_features
from pulseframe.operators.flatten import flatten_batches, flatten_samples
from pulseframe.operators.metrics import evaluate
from pulseframe.operators.validate import is_valid, validate_samples
from pulseframe.operators.windows import event_gate_reason, keep
from pulseframe.params import MetricParams, RunParams, ScaleParams
from pulseframe.plans.windows import session_features, sliding_features
from pulseframe.schemas import FEATURE_SCHEMA, SAMPLE_ORDER
from pulseframe.sources.models import SavedModel


class ScoringError(ValueError):
    """The input table cannot be scored as a whole."""


def score_batches(batches: DataFrame, model: SavedModel, scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Nested batches to scored sliding windows, with the model's own window and cleaning parameters."""
    windows = keep(sliding_features(flatten_batches(batches), model.params, scale))
    scored = predict(windows, model.classifier, "session_id")
    return scored.select("session_id", "window_index", "user_id", "device_id", "window_start", "window_end",
                         "n_samples", "probability", "prediction")


def score_samples(samples: DataFrame, model: SavedModel, scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Validated flat samples, one window per session, no cleaning. Errors in the table stop the job."""
    issues = validate_samples(samples, scale=scale)
    if not is_valid(issues):
        found = issues.filter(F.col("level") == "error").limit(10).collect()
        raise ScoringError("invalid samples: " + ", ".join(f"{r['check']}({r['key']})" for r in found))
    order = F.struct(*SAMPLE_ORDER)
    owner = [F.min_by("user_id", order).alias("user_id"), F.min_by("device_id", order).alias("device_id"),
             F.min("timestamp").alias("window_start"), F.max("timestamp").alias("window_end"), F.count(F.lit(1)).alias("n_samples")]
    windows = session_features(samples, model.params, scale, extra=owner)
    scored = predict(windows, model.classifier, "session_id")
    return scored.select("session_id", "user_id", "device_id", "window_start", "window_end", "n_samples", "probability", "prediction")


def check_feature_rows(features: DataFrame, names: Sequence[str] = FEATURE_SCHEMA,
                       keys: Sequence[str] = ("event_id",)) -> tuple[DataFrame, DataFrame]:
    """(rows that can be scored, rejects with the offending features).

    Missing or unexpected columns are an error for the whole table. Infinite values reject the row; missing
    values are allowed.
    """
    missing = [n for n in names if n not in features.columns]
    extra = sorted(set(features.columns) - set(names) - set(keys))
    if missing or extra:
        raise ScoringError(f"feature table does not fit the model: missing {missing}, unexpected {extra}")
    infinite = F.array_compact(F.array(*[F.when(F.abs(F.col(n).cast("double")) == F.lit(float("inf")), F.lit(n)) for n in names]))
    marked = features.withColumn("__infinite", infinite)
    good = marked.filter(F.size("__infinite") == 0).drop("__infinite")
    bad = marked.filter(F.size("__infinite") > 0).select(*keys, F.array_join("__infinite", ",").alias("infinite_features"))
    return good, bad


def score_features(features: DataFrame, model: SavedModel, keys: Sequence[str] = ("event_id",)) -> tuple[DataFrame, DataFrame]:
    """(scores, rejects): class 1 when the probability reaches the stored threshold; nothing is refitted."""
    good, bad = check_feature_rows(features, model.feature_names, keys)
    scored = predict(good, model.classifier, keys[0]).select(
        *keys, (F.col("probability") >= F.lit(model.threshold)).cast("int").alias("prediction"),
        F.col("probability").alias("support_probability"), F.lit(model.threshold).alias("threshold"),
        F.lit(model.model_version).alias("model_version"), F.lit(model.target).alias("target"))
    return scored, bad


def request_features(requests: DataFrame, params: RunParams = RunParams(), scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Features of each request's own samples within the closed window before its event, with the gate reason.

    A request carries its samples, so its window needs no join: only the flat rows are cut to [T - size, T].
    """
    size = micros(params.event_window.size_seconds)
    at = F.unix_micros("detected_at")
    trimmed = requests.withColumns({
        "window_start": F.timestamp_micros(at - size),
        "samples": F.filter("samples", lambda s: F.unix_micros(s["timestamp"]).between(at - size, at))})
    flat = flatten_samples(trimmed, ["window_start"]).withColumn("__has_hr", F.col("heart_rate_bpm").isNotNull())
    cleaned = clean(flat, params.clean, "event_id", scale, hot_keys(flat, ["event_id"], scale))
    gate = [F.count(F.lit(1)).alias("n_samples"), F.avg(F.when(F.col("__has_hr"), 1.0).otherwise(0.0)).alias("hr_ratio")]
    got = window_features(cleaned, ["event_id", "window_start"], params.features, extra=gate).drop("window_start")
    joined = requests.select("event_id").join(got, "event_id", "left")
    return joined.withColumn("reason", event_gate_reason(F.col("n_samples"), F.col("hr_ratio"), params.event_window))


def score_events(requests: DataFrame, model: SavedModel, scale: ScaleParams = ScaleParams()) -> tuple[DataFrame, DataFrame]:
    """(scores, rejects with reason) of event requests, under the window rules stored with the model."""
    got = request_features(requests, model.params, scale)
    usable = keep(got).select("event_id", *model.feature_names)
    scores, infinite = score_features(usable, model)
    refused = got.filter(F.col("reason").isNotNull()).select("event_id", "reason")
    return scores, refused.unionByName(infinite.select("event_id", F.concat(F.lit("infinite:"), "infinite_features").alias("reason")))


def scored_metrics(scored: DataFrame, labels: DataFrame, keys: Sequence[str], params: MetricParams = MetricParams(),
                   label: str = "label", scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Metrics of scored rows against labels on the same keys; rows without a partner are an error."""
    keys = list(keys)
    both = scored.select(*keys, "probability", "prediction").join(labels.select(*keys, F.col(label).alias("label")), keys, "full_outer")
    alone = both.filter(F.col("label").isNull() | F.col("probability").isNull()).count()
    if alone:
        raise ScoringError(f"labels do not fit the scored rows: {alone} without a partner")
    return evaluate(both, (), params, "label", "prediction", "probability", scale)
