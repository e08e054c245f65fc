"""Binary classification metrics, per group of ``by`` columns, so splits and models are just keys.

A metric whose denominator is empty is null and marked unavailable; it is never reported as 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scale import match_groups, running_totals
from pulseframe.operators.split import SPLITS
from pulseframe.params import FALLBACK_METRICS, MetricParams, ScaleParams

_F1_GUARD = 1e-10  # fixed value in the denominator of the threshold search


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction") -> DataFrame:
    """tn, fp, fn, tp, always all four."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


def count_metrics() -> dict[str, Column]:
    """Metrics that follow from the confusion counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    recall, specificity = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    return {
        "accuracy": _ratio(tp + tn, tn + fp + fn + tp),
        "precision": _ratio(tp, tp + fp),
        "recall": recall,
        "f1": F.when((tp + fp > 0) & (tp + fn > 0), 2 * tp / (2 * tp + fp + fn)),
        "balanced_accuracy": (recall + specificity) / 2,
        "specificity": specificity,
        "false_positive_rate": 1 - specificity,
    }


def score_counts(df: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, so ties are one row."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def ranked_scores(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score",
                  scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Per distinct score: counts, counts below it, and group totals. No group is sorted in one task."""
    ranked = running_totals(score_counts(df, by, label, score), by, ["score"], ["pos", "neg"], scale)
    totals = ranked.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    return match_groups(ranked, totals, by, ["all_pos", "all_neg"])


def _at_least() -> tuple[Column, Column]:
    """True and false positives when everything with at least this score is called positive."""
    return F.col("all_pos") - F.col("before_pos"), F.col("all_neg") - F.col("before_neg")


def ranking_metrics(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties averaged) and average precision; null unless both classes occur."""
    tp, fp = _at_least()
    both = (F.max("all_pos") > 0) & (F.max("all_neg") > 0)
    area = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2))
    precision = F.sum(F.col("pos") * tp / F.greatest(tp + fp, F.lit(1)))
    return ranked.groupBy(*by).agg(
        F.when(both, area / (F.max("all_pos").cast("double") * F.max("all_neg"))).alias("roc_auc"),
        F.when(both, precision / F.max("all_pos")).alias("average_precision"))


def best_f1_threshold(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The score with the best F1 when used as threshold, the lowest on ties, and that F1."""
    tp, fp = _at_least()
    p, r = tp / F.greatest(tp + fp, F.lit(1)), tp / F.greatest(F.col("all_pos"), F.lit(1))
    f1 = 2 * (p * r) / (p + r + F.lit(_F1_GUARD))
    scored = ranked.withColumn("f1", F.when(F.col("all_pos") > 0, f1))
    return scored.groupBy(*by).agg(
        F.max_by("score", F.when(F.col("f1").isNotNull(), F.struct(F.col("f1"), -F.col("score")))).alias("threshold"),
        F.max("f1").alias("f1"))


def predict_at(df: DataFrame, threshold: float | Column, score: str = "score") -> DataFrame:
    """prediction = score at or above the threshold."""
    return df.withColumn("prediction", (F.col(score) >= threshold).cast("int"))


def evaluate(df: DataFrame, by: Sequence[str] = (), params: MetricParams = MetricParams(), label: str = "label",
             prediction: str = "prediction", score: str | None = "score", scale: ScaleParams = ScaleParams(),
             ranks: DataFrame | None = None) -> DataFrame:
    """One row per group: counts, the configured metrics, and ``available``, a map metric -> defined.

    The stored threshold is only recorded here; it does not decide the predictions. ``ranks`` takes
    :func:`ranking_metrics` of the same groups when the caller has them already.
    """
    counts = confusion(df, by, label, prediction)
    ranking = ["roc_auc", "average_precision"]
    if ranks is None and score is not None and set(ranking) & set(params.metrics):
        ranks = ranking_metrics(ranked_scores(df, by, label, score, scale), by)
    if ranks is not None:
        counts = match_groups(counts, ranks, by, ranking)
    else:
        counts = counts.withColumns({m: F.lit(None).cast("double") for m in ranking})
    rules = count_metrics() | {m: F.col(m) for m in ("roc_auc", "average_precision")}
    chosen = [m for m in rules if m in params.metrics]
    out = counts.select(
        *by, *[F.col(c) for c in ("tn", "fp", "fn", "tp")],
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n_samples"), (F.col("fn") + F.col("tp")).alias("n_positive"),
        F.lit(float(params.threshold)).alias("threshold"), *[rules[m].cast("double").alias(m) for m in chosen])
    flags = F.map_from_arrays(F.array(*[F.lit(m) for m in chosen]), F.array(*[F.col(m).isNotNull() for m in chosen]))
    return out.withColumn("available", flags)


def evaluate_at(df: DataFrame, threshold: float, by: Sequence[str] = (), params: MetricParams = MetricParams(),
                label: str = "label", score: str = "score", scale: ScaleParams = ScaleParams()) -> DataFrame:
    """:func:`evaluate` with predictions from an explicit threshold."""
    at = MetricParams(params.metrics, threshold)
    return evaluate(predict_at(df, threshold, score), by, at, label, "prediction", score, scale)


def evaluate_splits(df: DataFrame, by: Sequence[str] = (), params: MetricParams = MetricParams(), label: str = "label",
                    prediction: str = "prediction", score: str | None = "score", scale: ScaleParams = ScaleParams(),
                    ranks: DataFrame | None = None) -> DataFrame:
    """One row per split and group; a split without rows gives a row of nulls."""
    got = evaluate(df, [*by, "split"], params, label, prediction, score, scale, ranks)
    names = df.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    if by:
        groups = got.select(*by).distinct()
        names = groups.withColumn("split", F.explode(F.array(*[F.lit(s) for s in SPLITS])))
    return names.join(got, [*by, "split"], "left")


def threshold_source(df: DataFrame, label: str = "label") -> str | None:
    """Validation when it has both classes, else train when it has, else None. Test is never looked at."""
    seen = df.filter(F.col("split").isin("val", "train")).groupBy("split").agg(
        F.min(label).alias("low"), F.max(label).alias("high")).collect()  # two rows
    both = {r["split"] for r in seen if r["low"] != r["high"]}
    return next((s for s in ("val", "train") if s in both), None)


def select_threshold(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score",
                     scale: ScaleParams = ScaleParams(), ranked: DataFrame | None = None) -> tuple[DataFrame, str]:
    """(threshold per group, split it came from): best F1 on :func:`threshold_source`, else 0.5 tagged val.

    All groups share the same rows, hence the same split. ``ranked`` takes :func:`ranked_scores` by
    (``by``, split) when the caller has them already.
    """
    source = threshold_source(df, label)
    if source is None:
        groups = df.select(*by).distinct() if by else df.sparkSession.range(1).drop("id")
        return groups.withColumn("threshold", F.lit(0.5)), "val"
    if ranked is None:
        ranked = ranked_scores(df.filter(F.col("split") == source), by, label, score, scale)
    else:
        ranked = ranked.filter(F.col("split") == source)
    return best_f1_threshold(ranked, by).select(*by, "threshold"), source


def configured(metrics: Sequence[str] | None) -> MetricParams:
    """Metric parameters from a configured list; without one, the shorter fallback list."""
    return MetricParams(tuple(metrics) if metrics is not None else FALLBACK_METRICS)
