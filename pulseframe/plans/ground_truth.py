"""The labelled event dataset with its exclusion ledger, from telemetry, detector events and decisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.columns import micros
from pulseframe.operators.contracts import normalize_documents
from pulseframe.operators.event_panes import ROWS_PER_TASK, dealt, event_pane_features
from pulseframe.operators.flatten import flatten_batches
from pulseframe.operators.labels import (
    TARGET, apply_label_policy, attach_suspected, conflict_rows, dedup_events, event_metadata, missing_decision,
    suspected_matches,
)
from pulseframe.operators.windows import event_gate_reason
from pulseframe.params import EventWindowParams, RunParams, ScaleParams
from pulseframe.session import cut_lineage


@dataclass(frozen=True)
class GroundTruth:
    """``dataset``: one row per usable event with metadata, label and features, keyed by event_id.
    ``exclusions``: (doc_id, kind, reason) of everything left out. ``judged``: every decision with its reason."""

    judged: DataFrame
    dataset: DataFrame
    exclusions: DataFrame
    features: tuple[str, ...]

    def summary(self) -> DataFrame:
        return dataset_summary(self)


def near_events(samples: DataFrame, events: DataFrame, params: EventWindowParams) -> DataFrame:
    """Samples that any window could reach, as a plain time range the scan can use to skip files."""
    at = F.unix_micros("detected_at")
    span = events.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    if span["low"] is None:
        return samples.limit(0)
    first, last = span["low"] - micros(params.size_seconds), span["high"]
    return samples.filter(F.col("timestamp").between(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last))))


def event_features(samples: DataFrame, events: DataFrame, params: RunParams = RunParams(),
                   scale: ScaleParams = ScaleParams(), as_of: Column | None = None) -> DataFrame:
    """Per event with at least one sample: raw row count, raw HR share, then features of the cleaned window.

    Each window is cleaned alone, so nothing after T can leak in. The gate reads the raw values, before any fill. Windows are
    put together from panes (:mod:`pulseframe.operators.event_panes`), so no row is made for an event and a sample.
    """
    return event_pane_features(near_events(samples, events, params.event_window), events, params, scale, as_of)


def judge_decisions(samples: DataFrame, suspected: DataFrame, decisions: DataFrame, params: RunParams = RunParams(),
                    scale: ScaleParams = ScaleParams(), as_of: Column | None = None) -> DataFrame:
    """Every deduplicated decision with its detector event, label, features and the first reason against it.

    Order of reasons: event_mismatch, missing_telemetry, insufficient_samples, unsupported_response. The linked
    decisions are checkpointed: they give the time range, the windows and the result rows.
    """
    linked = cut_lineage(attach_suspected(decisions, suspected).withColumn("__match", suspected_matches()))
    usable = linked.filter("__match").select("event_id", "session_id", "device_id", "user_id", "detected_at")
    found = event_features(samples, usable, params, scale, as_of)
    joined = apply_label_policy(linked.join(found, "event_id", "left"))
    reason = (F.when(~F.col("__match"), F.lit("event_mismatch"))
              .otherwise(F.coalesce(
                  event_gate_reason(F.col("n_samples"), F.col("hr_ratio"), params.event_window),
                  F.when(F.col(TARGET).isNull(), F.lit("unsupported_response")))))
    return joined.withColumn("reason", reason).drop("__match")


def dealt_events(suspected: DataFrame, decisions: DataFrame, key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """Both sides dealt by their id over the same tasks of about ROWS_PER_TASK rows.

    Folding copies and joining then need no exchange of their own, and sort no more than such a task holds. A side where one id
    has more copies than that stays as it is: its copies fold on the map side, whatever their number.
    """
    sides = [suspected, decisions]
    found = [df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.max("n").alias("most")).first()
             for df in sides]
    rows = max(side["rows"] for side in found)
    return tuple(dealt(df, rows, key) if (side["most"] or 0) <= ROWS_PER_TASK else df for df, side in zip(sides, found))


def build_ground_truth(samples: DataFrame, suspected: DataFrame, decisions: DataFrame, params: RunParams = RunParams(),
                       quarantine: DataFrame | None = None, scale: ScaleParams = ScaleParams(),
                       as_of: Column | None = None, materialize: bool = False) -> GroundTruth:
    """Dataset and ledger from flat samples and normalised documents.

    ``materialize`` checkpoints the judged decisions, so that dataset, ledger and reports read one result
    instead of repeating the telemetry join.
    """
    suspected, decisions = dealt_events(suspected, decisions)
    sus, sus_conflicts = dedup_events(suspected)
    dec, dec_conflicts = dedup_events(decisions)
    judged = judge_decisions(samples, sus, dec, params, scale, as_of)
    if materialize:
        judged = cut_lineage(judged)
    names = tuple(params.features.names())
    dataset = judged.filter(F.col("reason").isNull()).select(*event_metadata(judged), "n_samples", "hr_ratio", *names)
    rejected = judged.filter(F.col("reason").isNotNull()).select(
        F.col("event_id").alias("doc_id"), F.lit("decision").alias("kind"), "reason")
    exclusions = (rejected.unionByName(conflict_rows(sus_conflicts, "suspected"))
                  .unionByName(conflict_rows(dec_conflicts, "decision")).unionByName(missing_decision(sus, dec)))
    if quarantine is not None:
        exclusions = quarantine.select("doc_id", "kind", "reason").unionByName(exclusions)
    return GroundTruth(judged, dataset, exclusions, names)


def ground_truth_from_documents(telemetry: DataFrame, suspected: DataFrame, decisions: DataFrame,
                                params: RunParams = RunParams(), unknown: str = "drop", **kwargs) -> GroundTruth:
    """The same from raw documents in any key spelling; rejected documents enter the ledger first."""
    batches, bad_telemetry = normalize_documents(telemetry, "telemetry", unknown)
    sus, bad_suspected = normalize_documents(suspected, "suspected", unknown)
    dec, bad_decisions = normalize_documents(decisions, "decision", unknown)
    quarantine = bad_telemetry.unionByName(bad_suspected).unionByName(bad_decisions)
    return build_ground_truth(flatten_batches(batches), sus, dec, params, quarantine, **kwargs)


def dataset_summary(truth: GroundTruth) -> DataFrame:
    """(key, n): rows, features, label counts, the five drop counters and the exclusion total."""
    ds, reason = truth.dataset, F.col("reason")
    counts = truth.exclusions.agg(
        F.count_if(reason == "missing_telemetry").alias("dropped_no_telemetry"),
        F.count_if(reason == "insufficient_samples").alias("dropped_insufficient_data"),
        F.count_if(reason == "identity_mismatch").alias("identity_mismatches"),
        F.count_if(reason.isin("duplicate_suspected_conflict", "duplicate_decision_conflict")).alias("duplicate_conflicts"),
        F.count_if(reason == "event_mismatch").alias("event_mismatches"),
        F.count(F.lit(1)).alias("n_exclusions"))
    rows = ds.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(truth.features)).cast("bigint").alias("n_features"),
                  F.count_if(F.col(TARGET) == 0).alias("label_0"), F.count_if(F.col(TARGET) == 1).alias("label_1"))

    def long(df: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("key"), F.col(c).alias("n")) for c in df.columns]
        return df.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")

    return long(rows).unionByName(long(counts))
