"""Label policy, event deduplication and the joins between decisions, detector events and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Supported responses with target and category.
LABEL_POLICY = {
    "SUPPORT_REQUESTED": (1, "SUPPORT_REQUESTED"),
    "ACTIVITY_CONFIRMED": (0, "PHYSICAL_ACTIVITY"),
    "USER_OK": (0, "SELF_REPORTED_OK"),
}

# Reasons of the exclusion ledger.
EXCLUSION_REASONS = (
    "identity_mismatch", "duplicate_suspected_conflict", "duplicate_decision_conflict", "event_mismatch",
    "missing_decision", "unsupported_response", "missing_telemetry", "insufficient_samples", "invalid_document",
)

TARGET = "target_support_requested"


def apply_label_policy(df: DataFrame, col: str = "response") -> DataFrame:
    """Add target and category of the trimmed, upper-cased response; both null when it is unsupported.

    The response itself stays as it was.
    """
    spoken = F.upper(F.regexp_replace(F.col(col), r"(?U)^\s+|\s+$", ""))
    target, category = F.lit(None).cast("int"), F.lit(None).cast("string")
    for response, (value, name) in LABEL_POLICY.items():
        target = F.when(spoken == response, F.lit(value)).otherwise(target)
        category = F.when(spoken == response, F.lit(name)).otherwise(category)
    return df.withColumns({TARGET: target, "response_category": category})


def session_labels(windows: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Windows with the label of their session, null when the session has none."""
    return windows.join(labels.select("session_id", F.col(label).alias("label")), "session_id", "left")


def require_labels(labelled: DataFrame) -> DataFrame:
    """Raise when a window has no session or its session has no label."""
    missing = labelled.filter(F.col("label").isNull() | F.col("session_id").isNull())
    if not missing.isEmpty():
        example = missing.select("session_id").first()["session_id"]
        raise ValueError(f"no label for session {example}")
    return labelled


def _by_event(df: DataFrame, key: str) -> DataFrame:
    payload = F.struct(*[c for c in df.columns if c != key])
    return df.groupBy(key).agg(F.min(payload).alias("low"), F.max(payload).alias("high"))


def dedup_events(df: DataFrame, key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """(one row per id whose copies all agree, ids whose copies differ).

    Copies agree exactly when their smallest and largest content are equal, so any number of copies
    folds on the map side into two rows.
    """
    grouped = _by_event(df, key)
    agree = F.col("low").eqNullSafe(F.col("high"))
    kept = grouped.filter(agree).select(key, "low.*").select(*df.columns)
    return kept, grouped.filter(~agree).select(key)


def missing_decision(suspected: DataFrame, decisions: DataFrame) -> DataFrame:
    """Detector events without a surviving decision, as ledger rows."""
    return suspected.join(decisions, "event_id", "left_anti").select(
        F.col("event_id").alias("doc_id"), F.lit("suspected").alias("kind"), F.lit("missing_decision").alias("reason"))


def attach_suspected(decisions: DataFrame, suspected: DataFrame) -> DataFrame:
    """Decisions with their detector event as the struct column ``suspected`` (null when there is none)."""
    side = suspected.select("event_id", F.struct(*[c for c in suspected.columns if c != "event_id"]).alias("suspected"))
    return decisions.join(side, "event_id", "left")


def suspected_matches() -> Column:
    """Whether the attached detector event is about the same device, session and time, and user when both known."""
    other = F.col("suspected")
    same_user = (F.col("user_id").isNull() | other["user_id"].isNull() | (F.col("user_id") == other["user_id"]))
    agrees = ((F.col("device_id") == other["device_id"]) & (F.col("session_id") == other["session_id"])
              & (F.col("detected_at") == other["detected_at"]) & same_user)
    return other.isNull() | agrees


def conflict_rows(conflicts: DataFrame, kind: str) -> DataFrame:
    return conflicts.select(F.col("event_id").alias("doc_id"), F.lit(kind).alias("kind"),
                            F.lit(f"duplicate_{kind}_conflict").alias("reason"))


def event_metadata(labelled: DataFrame) -> list[Column]:
    """Metadata columns of a labelled decision. The detector columns are for audit and never enter a model."""
    return [
        *[F.col(c) for c in ("event_id", "user_id", "device_id", "session_id", "detected_at", "responded_at",
                             "response", "response_category", TARGET)],
        F.col("suspected").isNotNull().alias("has_suspected_event"),
        F.col("suspected.score").alias("detector_score"),
        F.col("suspected.state").alias("detector_state"),
        F.col("suspected.rules_version").alias("rules_version"),
        F.col("suspected.features").alias("watch_features_snapshot"),
        F.col("suspected.baseline").alias("watch_baseline_snapshot"),
    ]
