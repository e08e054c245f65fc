"""Event windows, labels, the exclusion ledger, validation, quality reports and parity."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe import fixtures as fx
from pulseframe.catalog.base import EVENTS, FAULTY, ORDER, SAMPLES, SIZE_US, SLIDING, TRUTH, Query, kinds
from pulseframe.catalog.telemetry import EVERYTHING, PARAMS, as_of
from pulseframe.operators import clean as cl
from pulseframe.operators import labels as lb
from pulseframe.operators import parity, qa, validate, windows
from pulseframe.params import FeatureToggles, QaParams, ReadinessParams
from pulseframe.plans.ground_truth import GroundTruth, build_ground_truth
from pulseframe.schemas import FEATURE_SCHEMA


def truth(spark, sf_dir, params=PARAMS, materialize=False) -> GroundTruth:
    return build_ground_truth(fx.samples(spark, sf_dir), fx.suspected(spark, sf_dir), fx.decisions(spark, sf_dir), params,
                              as_of=as_of(), materialize=materialize)


def stored(spark, sf_dir) -> GroundTruth:
    """Checkpointed, for reports that read the dataset several times."""
    return truth(spark, sf_dir, materialize=True)


def dataset(spark, sf_dir):
    return truth(spark, sf_dir).dataset


def _deduped(spark, sf_dir):
    return lb.dedup_events(fx.suspected(spark, sf_dir)), lb.dedup_events(fx.decisions(spark, sf_dir))


def _dedup_query(which: int, part: int):
    return lambda s, d: _deduped(s, d)[which][part]


def _attached(spark, sf_dir):
    (sus, _), (dec, _) = _deduped(spark, sf_dir)
    return lb.attach_suspected(dec, sus).select(
        "event_id", F.col("suspected").isNotNull().alias("has_suspected_event"), lb.suspected_matches().alias("matches"))


def _event_rows(spark, sf_dir):
    _, (dec, _) = _deduped(spark, sf_dir)
    return dec, windows.event_windows(fx.samples(spark, sf_dir), dec, fx.EVENT_WINDOW)


def _event_gate(spark, sf_dir):
    dec, rows = _event_rows(spark, sf_dir)
    return windows.event_window_gate(dec, rows, fx.EVENT_WINDOW)


def _anonymous_windows(spark, sf_dir):
    """Decisions without a user id match any user of the session and device."""
    (_, _), (dec, _) = _deduped(spark, sf_dir)
    anonymous = dec.withColumn("user_id", F.when(F.col("event_id").cast("bigint") % 2 == 0, F.lit("someone else")))
    return windows.event_windows(fx.samples(spark, sf_dir), anonymous, fx.EVENT_WINDOW)


def _session_labels(spark, sf_dir):
    meta = windows.window_metadata(windows.sliding_windows(cl.clean(fx.samples(spark, sf_dir)), fx.WINDOW))
    labels = (fx.table(spark, sf_dir, "events").select("user_id").distinct()
              .filter("user_id % 7 <> 0").select(F.col("user_id").cast("string").alias("session_id"), (F.col("user_id") % 2).alias("label")))
    return lb.session_labels(meta, labels)


def _features(spark, sf_dir):
    return truth(spark, sf_dir, EVERYTHING).dataset


def _click_batches(spark, sf_dir):
    """Samples without some whole sequence numbers, so that sequences have gaps."""
    return fx.samples(spark, sf_dir).filter("(CAST(session_id AS BIGINT) + sequence) % 3 <> 0")


def _out_of_order(spark, sf_dir):
    """A document order that is not the time order."""
    return fx.samples(spark, sf_dir).withColumns({
        "sequence": F.col("sequence") - F.when(F.col("pos") % 50 == 0, 1).otherwise(0),
        "user_id": F.when(F.col("pos") % 100 != 0, F.col("user_id"))})


_LONG = ", ".join(f"('{f}', CAST({f} AS DOUBLE))" for f in FEATURE_SCHEMA)
_UNPIVOT = f"SELECT u.f AS feature, u.v AS value FROM ds, (VALUES {_LONG}) AS u(f, v)"
_DESCRIBE = """SELECT feature, count(value) AS "count", avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
  quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, max(value) AS max FROM long GROUP BY feature"""
_STATS = kinds(s="feature", i="count", d="mean std min p25 p50 p75 max")

_PAIRS = [("heart_rate_mean", "hr_mean", 0.5, 0.02, "CASE WHEN sk % 5 <> 0 THEN 60 + sk END"), ("heart_rate_max", "hr_max", 0.5, 0.02, "90 + sk"),
          ("heart_rate_slope_bpm_per_minute", "hr_slope_bpm_per_min", 0.05, 0.05, "0"), ("rmssd_millis", "hrv_rmssd", 1.0, 0.05, "10 * sk"),
          ("sdnn_millis", "hrv_sdnn", 1.0, 0.05, "8 * sk"), ("valid_sample_ratio", "valid_sample_ratio", 0.01, 0.0, "0.8"),
          ("sample_count", "sample_count", 0.0, 0.0, "sk % 20")]


def _parity_sql(pairs) -> str:
    parts = [f"SELECT event_id, '{w}' AS watch_field, '{m}' AS ml_field, CAST({e} AS DOUBLE) AS w, CAST({ml} AS DOUBLE) AS m, CAST({a} AS DOUBLE) AS atol, CAST({r} AS DOUBLE) AS rtol FROM ds WHERE has_suspected_event"
             for w, m, ml, a, r, e in pairs]
    return f"""WITH {TRUTH}, pairs AS ({' UNION ALL '.join(parts)}),
parity AS (SELECT event_id, watch_field, ml_field, w AS watch_value, m AS ml_value, w - m AS diff, CASE WHEN m <> 0 THEN abs(w - m) / abs(m) END AS rel_diff,
  CASE WHEN w IS NULL AND m IS NULL THEN 'both_missing' WHEN w IS NULL THEN 'watch_missing' WHEN m IS NULL THEN 'ml_missing'
       WHEN abs(w - m) <= atol + rtol * abs(m) THEN 'match' ELSE 'diverging' END AS status FROM pairs)"""


_DIRECT = _parity_sql([(w, m, m, a, r, e) for w, m, a, r, e in _PAIRS])
_DERIVED = _parity_sql([("heart_rate_delta_from_baseline", "hr_mean - baseline.mean_heart_rate", "hr_mean - 70", 1.0, 0.05, "CASE WHEN sk % 4 <> 0 THEN sk - 10 END")])

_CATALOGUE = " UNION ALL ".join(
    [f"SELECT '{w}' AS field, 'compared' AS kind, count(CAST({e} AS DOUBLE) - {m}) AS n_present FROM ds WHERE has_suspected_event" for w, m, _, _, e in _PAIRS]
    + ["SELECT 'heart_rate_delta_from_baseline', 'derived', count(CASE WHEN sk % 4 <> 0 THEN sk - 10 END - hr_mean) FROM ds WHERE has_suspected_event"]
    + [f"SELECT '{f}', 'not_comparable', 0" for f in ("movement_magnitude_mean", "movement_variance")]
    + ["SELECT 'last_sample_age_seconds', 'watch_only', count(*) FROM ds WHERE has_suspected_event"]
    + [f"SELECT '{f}', 'ml_only', count({f}) FROM ds WHERE has_suspected_event" for f in (
        "hr_std", "hr_min", "ibi_available", "ibi_coverage_ratio", "skin_temp_mean", "quality_good_ratio", "quality_fair_ratio", "quality_poor_ratio", "window_duration_seconds")])

_BATCH_ROWS = f"""WITH {SAMPLES}, b AS (SELECT *, batch_id AS doc FROM samples),
g AS (SELECT *, (epoch_us(tm) - epoch_us(lag(tm) OVER (PARTITION BY doc ORDER BY pos))) / 1e6 AS gap FROM b)"""

_COUNTED = [("class", "target_support_requested"), ("user", "user_id"), ("session", "session_id"), ("device", "device_id"), ("response", "response"), ("response_category", "response_category")]
_COUNTS = " UNION ALL ".join(f"SELECT '{s}' AS section, CAST({c} AS VARCHAR) AS key, count(*) AS n FROM ds GROUP BY 2" for s, c in _COUNTED)
_ALL = " ".join(FeatureToggles.all_on().names())
_STRICT_QA = QaParams(missingness=0.001, min_rows=10_000_000)
_WARN = " UNION ALL ".join([f"SELECT 'high_missingness' AS warning, '{f}' AS subject FROM ds HAVING count(*) > 0 AND count(*) - count({f}) > count(*) * CAST(0.001 AS DOUBLE)" for f in FEATURE_SCHEMA]
                           + ["SELECT 'small_dataset', 'dataset' FROM ds HAVING count(*) < 10000000"])
_READY = " UNION ALL ".join([
    "SELECT 'not_empty' AS \"check\", count(*) > 0 AS ok, count(*) AS found FROM ds",
    "SELECT 'aligned', count(DISTINCT event_id) = count(*) AND count(target_support_requested) = count(*), least(count(DISTINCT event_id), count(target_support_requested)) FROM ds",
    "SELECT 'both_classes', count(DISTINCT target_support_requested) >= 2, count(DISTINCT target_support_requested) FROM ds",
    "SELECT 'has_group_column', true, 1", "SELECT 'enough_users', count(DISTINCT user_id) >= 2, count(DISTINCT user_id) FROM ds",
    "SELECT 'enough_rows', count(*) >= 10, count(*) FROM ds"])

# Every value of the quality report, as (section, key, value).
_STAT_NAMES = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
_KEPT = TRUTH.replace("\nds AS (", "\nds AS MATERIALIZED (").replace("\nledger AS (", "\nledger AS MATERIALIZED (").replace("judged AS (", "judged AS MATERIALIZED (")
_REPORT = f"""WITH {_KEPT}, c AS ({_COUNTS}), long AS ({_UNPIVOT}), st AS MATERIALIZED ({_DESCRIBE})
SELECT 'counts_' || section AS section, key, CAST(n AS DOUBLE) AS value FROM c
UNION ALL SELECT 'size', 'n_rows', count(*) FROM ds UNION ALL SELECT 'size', 'n_features', {len(FEATURE_SCHEMA)}
UNION ALL SELECT 'missing_ratio', feature, (count(*) - count(value)) / count(*) FROM long GROUP BY feature
UNION ALL SELECT 'ibi_coverage', 'n_no_ibi', count(*) FILTER (ibi_available = 0) FROM ds
UNION ALL SELECT 'ibi_coverage', 'ibi_available_mean', avg(ibi_available) FROM ds
UNION ALL SELECT 'ibi_coverage', 'ibi_coverage_ratio_mean', avg(ibi_coverage_ratio) FROM ds
UNION ALL SELECT 'exclusions', reason, count(*) FROM ledger GROUP BY reason
UNION ALL SELECT 'temporal', 'first_at', epoch_us(min(detected_at)) / 1e6 FROM ds UNION ALL SELECT 'temporal', 'last_at', epoch_us(max(detected_at)) / 1e6 FROM ds
UNION ALL SELECT 'temporal', 'span_seconds', (epoch_us(max(detected_at)) - epoch_us(min(detected_at))) / 1e6 FROM ds
UNION ALL SELECT 'temporal', 'span_days', (epoch_us(max(detected_at)) - epoch_us(min(detected_at))) / 1e6 / 86400.0 FROM ds
UNION ALL SELECT 'temporal', 'distinct_days', count(DISTINCT CAST(detected_at AS DATE)) FROM ds
""" + " ".join(f"UNION ALL SELECT 'distribution', feature || '.{k}', \"{k}\" FROM st" for k in _STAT_NAMES) + (
    f" UNION ALL SELECT 'warnings', 'high_missingness:' || feature, 1 FROM long GROUP BY feature HAVING count(*) - count(value) > count(*) * CAST({QaParams().missingness} AS DOUBLE)")

QUERIES = [
    Query("event_windows", lambda s, d: _event_rows(s, d)[1], kinds(s="event_id session_id", i="pos", t="window_start window_end"),
          f"WITH {SAMPLES}, {EVENTS} SELECT d.event_id, s.session_id, s.pos, d.detected_at - to_microseconds({SIZE_US}) AS window_start, d.detected_at AS window_end FROM dec d JOIN samples s ON s.session_id = d.session_id AND s.device_id = d.device_id AND s.tm BETWEEN d.detected_at - to_microseconds({SIZE_US}) AND d.detected_at"),
    Query("event_windows_any_user", _anonymous_windows, kinds(s="event_id", i="pos"),
          f"WITH {SAMPLES}, {EVENTS} SELECT d.event_id, s.pos FROM dec d JOIN samples s ON s.session_id = d.session_id AND s.device_id = d.device_id AND s.tm BETWEEN d.detected_at - to_microseconds({SIZE_US}) AND d.detected_at WHERE d.n % 2 = 1"),
    Query("event_window_gate", _event_gate, kinds(s="event_id reason", i="n_samples", d="hr_ratio"),
          f"WITH {SAMPLES}, {EVENTS}, c AS (SELECT d.event_id, count(s.pos) AS n_samples, count(s.heart_rate_bpm) / nullif(count(s.pos), 0) AS hr_ratio FROM dec d LEFT JOIN samples s ON s.session_id = d.session_id AND s.device_id = d.device_id AND s.tm BETWEEN d.detected_at - to_microseconds({SIZE_US}) AND d.detected_at GROUP BY d.event_id) "
          "SELECT *, CASE WHEN n_samples = 0 THEN 'missing_telemetry' WHEN n_samples < 10 OR hr_ratio < 0.3 THEN 'insufficient_samples' END AS reason FROM c"),
    Query("features_all_events", _features, kinds(s="event_id", i="n_samples", d="hr_ratio " + _ALL), f"WITH {TRUTH} SELECT * FROM ds"),
    Query("label_policy", lambda s, d: lb.apply_label_policy(fx.decisions(s, d)), kinds(s="event_id response response_category", i="target_support_requested"),
          f"WITH {SAMPLES}, {EVENTS} SELECT event_id, response, CASE upper(trim(response)) WHEN 'SUPPORT_REQUESTED' THEN 1 WHEN 'ACTIVITY_CONFIRMED' THEN 0 WHEN 'USER_OK' THEN 0 END AS target_support_requested, CASE upper(trim(response)) WHEN 'SUPPORT_REQUESTED' THEN 'SUPPORT_REQUESTED' WHEN 'ACTIVITY_CONFIRMED' THEN 'PHYSICAL_ACTIVITY' WHEN 'USER_OK' THEN 'SELF_REPORTED_OK' END AS response_category FROM decisions"),
    Query("session_labels", _session_labels, kinds(s="session_id", i="window_index label"),
          f"WITH {SLIDING} SELECT DISTINCT session_id, window_index, CASE WHEN CAST(session_id AS BIGINT) % 7 <> 0 THEN CAST(session_id AS BIGINT) % 2 END AS label FROM windowed"),
    Query("dedup_suspected", _dedup_query(0, 0), kinds(s="event_id session_id", t="detected_at", d="score"), f"WITH {SAMPLES}, {EVENTS} SELECT * FROM sus"),
    Query("dedup_decisions", _dedup_query(1, 0), kinds(s="event_id response", t="detected_at responded_at"), f"WITH {SAMPLES}, {EVENTS} SELECT * FROM dec"),
    Query("dedup_conflicts", lambda s, d: lb.conflict_rows(_deduped(s, d)[0][1], "suspected").unionByName(lb.conflict_rows(_deduped(s, d)[1][1], "decision")),
          kinds(s="doc_id kind reason"),
          f"WITH {SAMPLES}, {EVENTS} SELECT event_id AS doc_id, 'suspected' AS kind, 'duplicate_suspected_conflict' AS reason FROM sus_ids WHERE versions > 1 UNION ALL SELECT event_id, 'decision', 'duplicate_decision_conflict' FROM dec_ids WHERE versions > 1"),
    Query("missing_decisions", lambda s, d: lb.missing_decision(_deduped(s, d)[0][0], _deduped(s, d)[1][0]), kinds(s="doc_id kind reason"),
          f"WITH {SAMPLES}, {EVENTS} SELECT event_id AS doc_id, 'suspected' AS kind, 'missing_decision' AS reason FROM sus WHERE event_id NOT IN (SELECT event_id FROM dec)"),
    Query("suspected_match", _attached, kinds(s="event_id", b="has_suspected_event matches"),
          f"WITH {SAMPLES}, {EVENTS} SELECT d.event_id, s.event_id IS NOT NULL AS has_suspected_event, s.event_id IS NULL OR s.detected_at = d.detected_at AS matches FROM dec d LEFT JOIN sus s ON s.event_id = d.event_id"),
    Query("exclusion_ledger", lambda s, d: stored(s, d).exclusions, kinds(s="doc_id kind reason"), f"WITH {TRUTH} SELECT * FROM ledger"),
    Query("ground_truth_dataset", dataset,
          kinds(s="event_id user_id device_id session_id response response_category", t="detected_at responded_at", i="target_support_requested", b="has_suspected_event", d="detector_score " + " ".join(FEATURE_SCHEMA)),
          f"WITH {TRUTH} SELECT * FROM ds"),
    Query("dataset_summary", lambda s, d: stored(s, d).summary(), kinds(s="key", i="n"),
          f"WITH {TRUTH} " + " UNION ALL ".join(
              ["SELECT 'n_rows' AS key, count(*) AS n FROM ds", "SELECT 'n_features', 16", "SELECT 'label_0', count(*) FILTER (target_support_requested = 0) FROM ds", "SELECT 'label_1', count(*) FILTER (target_support_requested = 1) FROM ds"]
              + [f"SELECT '{k}', count(*) FILTER (reason = '{r}') FROM ledger" for k, r in (("dropped_no_telemetry", "missing_telemetry"), ("dropped_insufficient_data", "insufficient_samples"), ("identity_mismatches", "identity_mismatch"), ("event_mismatches", "event_mismatch"))]
              + ["SELECT 'duplicate_conflicts', count(*) FILTER (reason LIKE 'duplicate%') FROM ledger", "SELECT 'n_exclusions', count(*) FROM ledger"])),

    Query("validate_batch_gaps", lambda s, d: validate.validate_batches(fx.batches(s, d)).filter("check = 'large_gap'"), kinds(s="level check key", d="value"),
          f"{_BATCH_ROWS} SELECT 'warning' AS level, 'large_gap' AS \"check\", batch_id AS key, max(gap) AS value FROM g GROUP BY batch_id, doc HAVING max(gap) > 300"),
    Query("validate_batch_size", lambda s, d: validate.validate_batches(fx.faulty_batches(s, d)).filter("check IN ('no_samples', 'too_many_samples')"), kinds(s="level check key", d="value"),
          f"WITH {SAMPLES}, {FAULTY} SELECT CASE WHEN n = 0 THEN 'error' ELSE 'warning' END AS level, CASE WHEN n = 0 THEN 'no_samples' ELSE 'too_many_samples' END AS \"check\", batch_id AS key, n AS value FROM faulty WHERE n = 0 OR n > 600"),
    Query("validate_batch_order", lambda s, d: validate.validate_batches(
              fx.batches(s, d).withColumn("samples", F.when(F.size("samples") % 2 == 0, F.reverse("samples")).otherwise(F.col("samples")))).filter("check = 'unsorted_samples'"),
          kinds(s="level check key", d="value"),
          f"{_BATCH_ROWS} SELECT 'warning' AS level, 'unsorted_samples' AS \"check\", batch_id AS key, count(*) FILTER (gap > 0) AS value FROM g GROUP BY batch_id, doc HAVING count(*) % 2 = 0 AND count(*) FILTER (gap > 0) > 0"),
    Query("validate_batch_availability", lambda s, d: validate.validate_batches(fx.batches(s, d)).filter("check IN ('low_hr_availability', 'high_poor_ratio')"), kinds(s="level check key", d="value"),
          f"{_BATCH_ROWS}, r AS (SELECT batch_id, doc, count(heart_rate_bpm) / count(*) AS a, count(*) FILTER (quality_heart_rate = 'poor') / count(*) AS p FROM g GROUP BY batch_id, doc) SELECT 'warning' AS level, 'low_hr_availability' AS \"check\", batch_id AS key, a AS value FROM r WHERE a < 0.5 UNION ALL SELECT 'warning', 'high_poor_ratio', batch_id, p FROM r WHERE p > 0.3"),
    Query("validate_batch_hr_range", lambda s, d: validate.validate_batches(fx.batches(s, d)).filter("check = 'hr_out_of_range'"), kinds(s="level check key", d="value"),
          f"{_BATCH_ROWS} SELECT 'warning' AS level, 'hr_out_of_range' AS \"check\", batch_id AS key, heart_rate_bpm AS value FROM g WHERE heart_rate_bpm < 30 OR heart_rate_bpm > 220"),
    Query("validate_ibi_consistency", lambda s, d: validate.validate_batches(fx.batches(s, d)).filter("check = 'ibi_inconsistent'"), kinds(s="level check key", d="value"),
          f"{_BATCH_ROWS} SELECT 'warning' AS level, 'ibi_inconsistent' AS \"check\", batch_id AS key, abs(60000 / heart_rate_bpm - list_avg(ibi_ms)) / (60000 / heart_rate_bpm) AS value FROM g WHERE heart_rate_bpm <> 0 AND len(ibi_ms) > 0 AND abs(60000 / heart_rate_bpm - list_avg(ibi_ms)) / (60000 / heart_rate_bpm) > 0.2"),
    Query("validate_frame_order", lambda s, d: validate.validate_samples(_out_of_order(s, d)), kinds(s="level check key", d="value"),
          f"WITH {SAMPLES}, o AS (SELECT * REPLACE (sequence - CASE WHEN pos % 50 = 0 THEN 1 ELSE 0 END AS sequence, CASE WHEN pos % 100 <> 0 THEN user_id END AS user_id) FROM samples), l AS (SELECT session_id, tm, lag(tm) OVER (PARTITION BY session_id ORDER BY sequence, pos) AS before FROM o) "
          "SELECT 'warning' AS level, 'timestamps_not_monotonic' AS \"check\", session_id AS key, count(*) AS value FROM l WHERE tm < before GROUP BY session_id UNION ALL SELECT 'error', 'null_values', 'user_id', count(*) FROM o WHERE user_id IS NULL HAVING count(*) > 0 UNION ALL SELECT 'warning', 'hr_out_of_range', 'heart_rate_bpm', count(*) FROM o WHERE heart_rate_bpm < 30 OR heart_rate_bpm > 220 HAVING count(*) > 0"),
    Query("sequence_gaps", lambda s, d: validate.sequence_gaps(_click_batches(s, d)), kinds(s="session_id", i="previous sequence missing"),
          f"WITH {SAMPLES}, q AS (SELECT DISTINCT session_id, sequence FROM samples WHERE (CAST(session_id AS BIGINT) + sequence) % 3 <> 0), l AS (SELECT *, lag(sequence) OVER (PARTITION BY session_id ORDER BY sequence) AS previous FROM q) SELECT session_id, previous, sequence, sequence - previous - 1 AS missing FROM l WHERE sequence > previous + 1"),

    Query("qa_value_counts", lambda s, d: qa.value_counts(dataset(s, d)), kinds(s="section key", i="n"), f"WITH {TRUTH} {_COUNTS}"),
    Query("qa_missingness", lambda s, d: qa.feature_missingness(dataset(s, d), QaParams(missingness=0.001)), kinds(s="feature", i="n_missing", d="missing_ratio", b="flagged"),
          f"WITH {TRUTH}, long AS ({_UNPIVOT}) SELECT feature, count(*) - count(value) AS n_missing, (count(*) - count(value)) / count(*) AS missing_ratio, (count(*) - count(value)) / count(*) > 0.001 AS flagged FROM long GROUP BY feature"),
    Query("qa_ibi_coverage", lambda s, d: qa.ibi_coverage(dataset(s, d)), kinds(i="n_no_ibi", d="ibi_available_mean ibi_coverage_ratio_mean"),
          f"WITH {TRUTH} SELECT count(*) FILTER (ibi_available = 0) AS n_no_ibi, avg(ibi_available) AS ibi_available_mean, avg(ibi_coverage_ratio) AS ibi_coverage_ratio_mean FROM ds"),
    Query("qa_samples_per_window", lambda s, d: qa.samples_per_window(stored(s, d).dataset), _STATS,
          f"WITH {TRUTH}, long AS (SELECT 'sample_count' AS feature, CAST(sample_count AS DOUBLE) AS value FROM ds) {_DESCRIBE}"),
    Query("qa_describe", lambda s, d: qa.describe_features(stored(s, d).dataset), _STATS, f"WITH {TRUTH}, long AS ({_UNPIVOT}) {_DESCRIBE}"),
    Query("qa_exclusions", lambda s, d: qa.exclusions_by_reason(truth(s, d).exclusions), kinds(s="reason", i="n"), f"WITH {TRUTH} SELECT reason, count(*) AS n FROM ledger GROUP BY reason"),
    Query("qa_temporal", lambda s, d: qa.temporal_coverage(dataset(s, d)), kinds(t="first_at last_at", d="span_seconds span_days", i="distinct_days"),
          f"WITH {TRUTH}, r AS (SELECT min(detected_at) AS first_at, max(detected_at) AS last_at, (epoch_us(max(detected_at)) - epoch_us(min(detected_at))) / 1e6 AS span_seconds, count(DISTINCT CAST(detected_at AS DATE)) AS distinct_days FROM ds) SELECT *, span_seconds / 86400 AS span_days FROM r"),
    Query("qa_warnings", lambda s, d: qa.qa_warnings(dataset(s, d), _STRICT_QA), kinds(s="warning subject"), f"WITH {TRUTH} {_WARN}"),
    Query("qa_report", lambda s, d: (lambda t: qa.dataset_qa(t.dataset, t.exclusions))(stored(s, d)), kinds(s="section key", d="value"), _REPORT),
    Query("readiness", lambda s, d: qa.check_ready(dataset(s, d), ReadinessParams()), kinds(s="check", b="ok", i="found"), f"WITH {TRUTH} {_READY}"),

    Query("parity_wide", lambda s, d: parity.parity_wide(dataset(s, d)), kinds(s="event_id", d=" ".join(f"diff_{p[0]}" for p in _PAIRS)),
          f"WITH {TRUTH} SELECT event_id, " + ", ".join(f"CAST({e} AS DOUBLE) - {m} AS diff_{w}" for w, m, _, _, e in _PAIRS) + " FROM ds WHERE has_suspected_event"),
    Query("parity_rows", lambda s, d: parity.parity_rows(dataset(s, d)), kinds(s="event_id watch_field ml_field status", d="watch_value ml_value diff rel_diff"), f"{_DIRECT} SELECT * FROM parity"),
    Query("parity_derived", lambda s, d: parity.parity_derived(dataset(s, d)), kinds(s="event_id watch_field expression status", d="watch_value ml_value diff rel_diff"), f"{_DERIVED} SELECT *, ml_field AS expression FROM parity"),
    Query("parity_summary", lambda s, d: parity.parity_summary(parity.parity_rows(stored(s, d).dataset)),
          kinds(s="watch_field ml_field", i="n_pairs n_both_present n_match n_diverging n_watch_missing n_ml_missing", d="mean_abs_diff median_abs_diff max_abs_diff mean_rel_diff"),
          f"{_DIRECT} SELECT watch_field, ml_field, count(*) AS n_pairs, count(diff) AS n_both_present, count(*) FILTER (status = 'match') AS n_match, count(*) FILTER (status = 'diverging') AS n_diverging, count(*) FILTER (status = 'watch_missing') AS n_watch_missing, count(*) FILTER (status = 'ml_missing') AS n_ml_missing, avg(abs(diff)) AS mean_abs_diff, quantile_cont(abs(diff), 0.5) AS median_abs_diff, max(abs(diff)) AS max_abs_diff, avg(rel_diff) AS mean_rel_diff FROM parity GROUP BY watch_field, ml_field"),
    Query("parity_catalogue", lambda s, d: parity.field_catalogue(dataset(s, d)), kinds(s="field kind", i="n_present"), f"WITH {TRUTH} {_CATALOGUE}"),
    Query("parity_warnings", lambda s, d: parity.parity_warnings(dataset(s, d)), kinds(s="warning", i="n"),
          f"WITH {TRUTH} SELECT 'no_watch_snapshot' AS warning, count(*) AS n FROM ds WHERE NOT has_suspected_event HAVING count(*) > 0"),
]
