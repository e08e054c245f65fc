"""Baseline and logistic classifiers on prepared inputs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.labels import TARGET
from pulseframe.operators.prep import PrepStats, prep_sql, require_columns
from pulseframe.params import DummyParams, LogisticParams

_DRAW_STEPS = 2.0 ** 32


@dataclass(frozen=True)
class Classifier:
    """A fitted classifier: either Spark ML stages (preparation, assembly, regression) or a baseline rule."""

    kind: str                              # "logistic_regression" | "dummy"
    features: tuple[str, ...]
    stages: PipelineModel | None = None
    prep: PrepStats | None = None
    baseline: dict = field(default_factory=dict)


def class_counts(train: DataFrame, label: str = TARGET) -> dict[int, int]:
    return {int(r[label]): r["count"] for r in train.groupBy(label).count().collect()}  # one row per class


def class_weights(train: DataFrame, label: str = TARGET) -> DataFrame:
    """(label, n, weight) with balanced weights n / (2 * n_class)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).first()["total"]
    return counts.withColumn("weight", F.lit(total) / (2 * F.col("n")))


def fit_logistic(train: DataFrame, prep: PrepStats, params: LogisticParams = LogisticParams(), label: str = TARGET) -> Classifier:
    """L2 logistic regression where C multiplies the loss, so the penalty is 1 / (C * sum of weights)."""
    counts = class_counts(train, label)
    if set(counts) != {0, 1}:
        raise ValueError(f"training needs both classes, found {sorted(counts)}")
    n = sum(counts.values())
    weights = {c: n / (2 * k) for c, k in counts.items()} if params.class_weight == "balanced" else {c: 1.0 for c in counts}
    scaled = ", ".join(f"{sql} AS `{name}`" for name, sql in prep_sql(prep).items())
    sql = SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
    assembler = VectorAssembler(inputCols=prep.outputs(), outputCol="x")
    ready = assembler.transform(sql.transform(train.select(*prep.features, label))).select(
        "x", F.col(label).cast("double").alias("label"), F.when(F.col(label) == 1, weights[1]).otherwise(weights[0]).alias("weight"))
    penalty = 1.0 / (params.C * sum(weights[c] * k for c, k in counts.items()))
    fitted = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="weight", regParam=penalty, elasticNetParam=0.0,
        standardization=False, maxIter=params.max_iter, tol=1e-8, rawPredictionCol="raw", probabilityCol="class_probability",
        predictionCol="class").fit(ready)
    return Classifier("logistic_regression", prep.features, PipelineModel(stages=[sql, assembler, fitted]), prep)


def fit_dummy(train: DataFrame, features: tuple[str, ...], params: DummyParams = DummyParams(), label: str = TARGET) -> Classifier:
    """A baseline that ignores the features: the class prior and a strategy."""
    counts = class_counts(train, label)
    prior = counts.get(1, 0) / max(sum(counts.values()), 1)
    return Classifier("dummy", tuple(features), baseline={
        "strategy": params.strategy, "constant": params.constant, "seed": params.seed, "prior": prior})


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the row key and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_DRAW_STEPS)


def dummy_columns(baseline: dict, key: Column) -> tuple[Column, Column]:
    """(probability of class 1, predicted class) of a baseline rule."""
    prior, chance = F.lit(float(baseline["prior"])), draw(key, baseline["seed"])
    strategy = baseline["strategy"]
    if strategy == "prior":
        return prior, (prior > 0.5).cast("int")
    if strategy == "constant":
        return F.lit(float(baseline["constant"])), F.lit(int(baseline["constant"]))
    if strategy == "stratified":
        hit = (chance < prior).cast("int")
        return hit.cast("double"), hit
    if strategy == "uniform":
        return F.lit(0.5), (chance < 0.5).cast("int")
    raise ValueError(f"unknown baseline strategy '{strategy}'")


def predict(df: DataFrame, model: Classifier, key: str = "event_id") -> DataFrame:
    """Add ``probability`` and the classifier's own ``prediction`` (class 1 when strictly more likely)."""
    if model.kind == "dummy":
        probability, prediction = dummy_columns(model.baseline, F.col(key))
        return df.withColumns({"probability": probability, "prediction": prediction})
    require_columns(df, model.features)
    out = model.stages.transform(df).withColumn("probability", vector_to_array("class_probability")[1])
    return out.select(*df.columns, "probability", (F.col("probability") > 0.5).cast("int").alias("prediction"))
