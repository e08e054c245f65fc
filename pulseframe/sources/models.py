"""Saved models: Spark ML stages plus one line of metadata. No ids, rows or split members inside."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from pulseframe.operators.classifiers import Classifier
from pulseframe.operators.prep import PrepStats
from pulseframe.params import RunParams

# Format tags checked on load, and the metadata a model must carry.
FORMAT_VERSION = 1
ARTIFACT_TYPE = "pulseframe_model"
REQUIRED = ("model_version", "target", "threshold", "threshold_source", "feature_names")


class ModelError(ValueError):
    """The stored model cannot be used."""


@dataclass(frozen=True)
class SavedModel:
    """A classifier with the threshold, target and parameters it was trained with."""

    classifier: Classifier
    model_version: str
    target: str
    threshold: float
    threshold_source: str
    feature_names: tuple[str, ...]
    params: RunParams = field(default_factory=RunParams)

    def __post_init__(self):
        if len(set(self.feature_names)) != len(self.feature_names):
            raise ModelError("feature names repeat")


def save_model(spark: SparkSession, model: SavedModel, path: str) -> None:
    """Write ``path/stages`` (when there are any) and ``path/metadata``."""
    clf = model.classifier
    meta = {
        "artifact_type": ARTIFACT_TYPE, "format_version": FORMAT_VERSION, "kind": clf.kind,
        "model_version": model.model_version, "target": model.target, "threshold": float(model.threshold),
        "threshold_source": model.threshold_source, "feature_names": list(model.feature_names),
        "inputs": list(clf.features), "prep": clf.prep.to_dict() if clf.prep else None, "baseline": clf.baseline,
        "params": model.params.to_dict(),
    }
    if clf.stages is not None:
        clf.stages.write().overwrite().save(f"{path}/stages")
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> SavedModel:
    """Read a model back; a wrong type, version or missing metadata is refused."""
    row = spark.read.text(f"{path}/metadata").first()
    meta = json.loads(row["value"]) if row else {}
    if meta.get("artifact_type") != ARTIFACT_TYPE:
        raise ModelError(f"not a model of this library: {meta.get('artifact_type')}")
    if meta.get("format_version") != FORMAT_VERSION:
        raise ModelError(f"format version {meta.get('format_version')} is not supported")
    missing = [k for k in REQUIRED if meta.get(k) is None]
    if missing:
        raise ModelError(f"model metadata lacks {', '.join(missing)}")
    stages = PipelineModel.load(f"{path}/stages") if meta["kind"] != "dummy" else None
    prep = PrepStats.from_dict(meta["prep"]) if meta["prep"] else None
    clf = Classifier(meta["kind"], tuple(meta["inputs"]), stages, prep, meta["baseline"])
    return SavedModel(clf, str(meta["model_version"]), str(meta["target"]), float(meta["threshold"]),
                      str(meta["threshold_source"]), tuple(meta["feature_names"]), RunParams.from_dict(meta["params"]))
