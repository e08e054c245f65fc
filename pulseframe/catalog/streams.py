"""Streaming forms, run to the end of what has arrived and compared as final tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe import fixtures as fx
from pulseframe.catalog.base import CLEANED, EVENTS, ORDER, SAMPLES, SIZE_US, STRIDE_US, WINDOWED, Query, features_sql, kinds
from pulseframe.catalog.modelling import _model
from pulseframe.catalog.telemetry import EVERYTHING, as_of, telemetry_documents, uuid_sql
from pulseframe.operators.windows import keep
from pulseframe.params import FeatureToggles
from pulseframe.sources.documents import stream_documents
from pulseframe.streaming import sessions, sinks
from pulseframe.streaming import streams as st

_DELAY = "10 minutes"
# Events shifted by ten years are set aside: the clock stands at the table's last event.
_PLAUSIBLE = "<= (SELECT max(ts) FROM events) + INTERVAL 1 DAY"
_EVENT = ["event_id", "session_id", "device_id", "user_id", "detected_at"]
_SUMMED = "hr_mean hr_std hr_min hr_max hr_slope_bpm_per_min ibi_available ibi_coverage_ratio skin_temp_mean quality_good_ratio quality_fair_ratio quality_poor_ratio valid_sample_ratio window_duration_seconds sample_count"


def _finish(spark, stream):
    """Run a stream over all arrived files into parquet and read the result."""
    base = fx.scratch(spark)
    schema = stream.schema
    st.run_available(stream, f"{base}/out", f"{base}/progress")
    return spark.read.schema(schema).parquet(f"{base}/out")


def _events(spark, sf_dir):
    return fx.event_stream(spark, sf_dir)


def _now(spark, sf_dir):
    return F.lit(fx.table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).first()[0])


def _routed(spark, sf_dir, split, stream, reasons):
    base = fx.scratch(spark)
    return sinks.route(stream, split, f"{base}/sinks", f"{base}/progress", reasons)


def _aside(spark, sf_dir):
    """Every input row, with the sink that it went to."""
    stream = fx.suspected(spark, sf_dir, _events(spark, sf_dir)).select(*_EVENT)
    out = _routed(spark, sf_dir, sinks.split_events(now=_now(spark, sf_dir)), stream, {"set_aside": ["from_the_future"]})
    aside = T.StructType([*stream.schema, T.StructField("reason", T.StringType())])
    return out.part(spark, "kept", stream.schema).withColumn("reason", F.lit(None).cast("string")).unionByName(out.part(spark, "set_aside", aside))


def _quarantine(spark, sf_dir):
    return _document_sinks(spark, sf_dir).part(spark, "quarantine", T.StructType().add("doc_id", "string").add("kind", "string").add("reason", "string"))


def _document_sinks(spark, sf_dir):
    base = fx.scratch(spark)
    telemetry_documents(spark, sf_dir).write.text(base)
    return _routed(spark, sf_dir, sinks.split_samples(), stream_documents(spark, base, "telemetry", 2), {"quarantine": sinks.REJECTED})


def _ledger(spark, sf_dir):
    return _document_sinks(spark, sf_dir).ledger(spark).groupBy("sink", "reason").agg(F.sum("n").alias("n"))


def _samples(spark, sf_dir):
    return fx.samples(spark, sf_dir, _events(spark, sf_dir)).withWatermark("timestamp", _DELAY)


def _documents(spark, sf_dir):
    base = fx.scratch(spark)
    telemetry_documents(spark, sf_dir).write.text(base)
    return _finish(spark, st.stream_samples(spark, base))


def _dedup(spark, sf_dir):
    """Each kept event once, and the rows set aside."""
    kept = _finish(spark, st.dedup_events_stream(fx.suspected(spark, sf_dir, _events(spark, sf_dir)), now=_now(spark, sf_dir)).select("event_id"))
    aside = _aside(spark, sf_dir).filter("reason IS NOT NULL").select("event_id", "reason")
    return kept.withColumn("reason", F.lit(None).cast("string")).unionByName(aside)


def _windows(spark, sf_dir):
    events = st.dedup_events_stream(fx.decisions(spark, sf_dir, _events(spark, sf_dir)).select(*_EVENT), now=_now(spark, sf_dir))
    return _finish(spark, st.event_windows_stream(_samples(spark, sf_dir), events, fx.EVENT_WINDOW).select("event_id", "timestamp"))


def _sliding(spark, sf_dir):
    return _finish(spark, st.sliding_features_stream(_samples(spark, sf_dir), fx.WINDOW))


def _session_features(spark, sf_dir):
    """Windows of sessions, a session ending with a pause of two days."""
    stream = sessions.session_features_stream(_samples(spark, sf_dir), EVERYTHING, _PAUSE_US / 1e6, as_of())
    with sessions.ordered_state(spark):
        return keep(_finish(spark, stream))


def _gated(spark, sf_dir):
    events = st.dedup_events_stream(fx.decisions(spark, sf_dir, _events(spark, sf_dir)).select(*_EVENT), now=_now(spark, sf_dir))
    return _finish(spark, st.event_gate_stream(_samples(spark, sf_dir), events, fx.EVENT_WINDOW))


def _linked(spark, sf_dir):
    sus = st.dedup_events_stream(fx.suspected(spark, sf_dir, _events(spark, sf_dir)).select(*_EVENT), now=_now(spark, sf_dir))
    dec = fx.decisions(spark, sf_dir, _events(spark, sf_dir)).select("event_id", "responded_at", "response")
    dec = st.dedup_events_stream(dec, time="responded_at", now=_now(spark, sf_dir))
    return _finish(spark, st.link_decisions_stream(sus, dec, 300).select("event_id", F.col("response").isNotNull().alias("answered")))


def _scored(spark, sf_dir):
    model = _model(spark, sf_dir)
    features = st.sliding_features_stream(_samples(spark, sf_dir), fx.WINDOW, FeatureToggles())
    return _finish(spark, st.score_stream(features, model).select("session_id", "window_start", "probability", "prediction", "model_version"))


_WATERMARK = "(SELECT max(tm) - INTERVAL 10 MINUTE FROM samples)"
_ALIGNED = f"""spans AS (SELECT session_id, unnest(range((epoch_us(tm) - {SIZE_US}) // {STRIDE_US} + 1, epoch_us(tm) // {STRIDE_US} + 1)) AS k, * EXCLUDE (session_id) FROM samples),
placed AS (SELECT *, make_timestamp(k * {STRIDE_US}) AS window_start, make_timestamp(k * {STRIDE_US} + {SIZE_US}) AS window_end FROM spans)"""

# A session's stretch between pauses is a session of its own; a window is there once a released sample lies at or behind its end, a short
# stretch once its pause is over.
_PAUSE_US = 172_800_000_000
_STRETCHES = SAMPLES.replace("samples AS (SELECT", "arrived AS (SELECT", 1) + f""",
marked AS (SELECT *, CASE WHEN epoch_us(tm) - epoch_us(lag(tm) OVER (PARTITION BY session_id ORDER BY {ORDER})) > {_PAUSE_US} THEN 1 ELSE 0 END AS cut FROM arrived),
samples AS (SELECT * EXCLUDE (cut) REPLACE (session_id || '/' || CAST(sum(cut) OVER (PARTITION BY session_id ORDER BY {ORDER}) AS VARCHAR) AS session_id) FROM marked),
{CLEANED}, {WINDOWED},
wm AS (SELECT max(tm) - INTERVAL 10 MINUTE AS wm FROM arrived),
seen AS (SELECT session_id, max(tm) FILTER (WHERE tm <= wm) AS released FROM samples, wm GROUP BY session_id)"""
_ALL = " ".join(FeatureToggles.all_on().names())

QUERIES = [
    Query("stream_samples", _documents,
          kinds(s="batch_id user_id session_id quality_heart_rate", i="sequence", t="timestamp", d="heart_rate_bpm skin_temperature_celsius"),
          f"""WITH {SAMPLES} SELECT {uuid_sql('b', 'batch_id')} AS batch_id, {uuid_sql('u', 'user_id')} AS user_id, {uuid_sql('s', 'session_id')} AS session_id,
  quality_heart_rate, sequence, tm AS "timestamp", heart_rate_bpm, skin_temperature_celsius FROM samples WHERE CAST(session_id AS BIGINT) % 10 <> 0"""),
    Query("stream_dedup_events", _dedup, kinds(s="event_id reason"), f"WITH {SAMPLES}, {EVENTS} SELECT DISTINCT event_id, NULL AS reason FROM suspected WHERE detected_at {_PLAUSIBLE} "
          f"UNION ALL SELECT event_id, 'from_the_future' FROM suspected WHERE NOT detected_at {_PLAUSIBLE}"),
    Query("stream_set_aside", _aside, kinds(s="event_id session_id reason", t="detected_at"),
          f"WITH {SAMPLES}, {EVENTS} SELECT event_id, session_id, detected_at, CASE WHEN NOT detected_at {_PLAUSIBLE} THEN 'from_the_future' END AS reason FROM suspected"),
    Query("stream_quarantine", _quarantine, kinds(s="doc_id kind reason"),
          f"WITH {SAMPLES}, b AS (SELECT DISTINCT batch_id, session_id FROM samples) SELECT 'not-a-uuid' AS doc_id, 'telemetry' AS kind, 'invalid_document' AS reason FROM b WHERE CAST(session_id AS BIGINT) % 10 = 0"),
    Query("stream_ledger", _ledger, kinds(s="sink reason", i="n"),
          f"WITH {SAMPLES}, b AS (SELECT DISTINCT batch_id, session_id FROM samples) SELECT 'samples' AS sink, NULL AS reason, count(*) AS n FROM samples WHERE CAST(session_id AS BIGINT) % 10 <> 0 "
          "UNION ALL SELECT 'quarantine', 'invalid_document', count(*) FROM b WHERE CAST(session_id AS BIGINT) % 10 = 0"),
    Query("stream_event_windows", _windows, kinds(s="event_id", t="timestamp"),
          f"WITH {SAMPLES}, {EVENTS}, d AS (SELECT DISTINCT event_id, session_id, device_id, user_id, detected_at FROM decisions WHERE detected_at {_PLAUSIBLE}) SELECT d.event_id, s.tm AS \"timestamp\" FROM d JOIN samples s ON s.session_id = d.session_id AND s.device_id = d.device_id AND s.user_id = d.user_id AND s.tm BETWEEN d.detected_at - to_microseconds({SIZE_US}) AND d.detected_at"),
    Query("stream_sliding_features", _sliding, kinds(s="session_id", t="window_start window_end", i="n_samples", d=_SUMMED),
          f"WITH {SAMPLES}, {_ALIGNED}, w AS (SELECT * FROM placed WHERE window_end <= {_WATERMARK}), f AS "
          + "(SELECT session_id, window_start, window_end, count(*) AS n_samples, count(heart_rate_bpm) / count(*) AS hr_ratio, avg(heart_rate_bpm) AS hr_mean, CASE WHEN count(heart_rate_bpm) = 1 THEN 0 ELSE stddev_samp(heart_rate_bpm) END AS hr_std, min(heart_rate_bpm) AS hr_min, max(heart_rate_bpm) AS hr_max, "
          "CASE WHEN count(heart_rate_bpm) = 1 THEN 0 ELSE regr_slope(heart_rate_bpm, (epoch_us(tm) - epoch_us(window_start)) / 6e7) END AS hr_slope_bpm_per_min, max(CASE WHEN len(ibi_ms) > 0 THEN 1 ELSE 0 END) AS ibi_available, avg(CASE WHEN len(ibi_ms) > 0 THEN 1.0 ELSE 0.0 END) AS ibi_coverage_ratio, avg(skin_temperature_celsius) AS skin_temp_mean, "
          "avg(CASE WHEN quality_heart_rate = 'good' THEN 1.0 ELSE 0.0 END) AS quality_good_ratio, avg(CASE WHEN quality_heart_rate = 'fair' THEN 1.0 ELSE 0.0 END) AS quality_fair_ratio, avg(CASE WHEN quality_heart_rate = 'poor' THEN 1.0 ELSE 0.0 END) AS quality_poor_ratio, avg(CASE WHEN heart_rate_bpm IS NOT NULL AND quality_heart_rate <> 'poor' THEN 1.0 ELSE 0.0 END) AS valid_sample_ratio, "
          "(epoch_us(max(tm)) - epoch_us(min(tm))) / 1e6 AS window_duration_seconds, count(*) AS sample_count FROM w GROUP BY session_id, window_start, window_end) SELECT * FROM f WHERE n_samples >= 10 AND hr_ratio >= 0.3"),
    Query("stream_session_features", _session_features, kinds(s="session_id user_id device_id", i="window_index n_samples", t="window_start window_end", d="hr_ratio " + _ALL),
          f"WITH {_STRETCHES} SELECT f.* REPLACE (split_part(f.session_id, '/', 1) AS session_id), f.first_user AS user_id, f.first_device AS device_id FROM "
          + features_sql("windowed", "session_id, window_index, window_start, window_end, first_user, first_device", "window_start", "count(*) AS n_samples, count(heart_rate_bpm) / count(*) AS hr_ratio")
          + f" AS f JOIN bounds b ON b.session_id = f.session_id JOIN seen ON seen.session_id = f.session_id, wm WHERE n_samples >= 10 AND hr_ratio >= 0.3 "
          f"AND CASE WHEN dur < {SIZE_US} THEN s1 + to_microseconds({_PAUSE_US}) <= wm ELSE window_end <= released END"),
    Query("stream_event_gate", _gated, kinds(s="event_id reason", i="n_samples", d="hr_ratio"),
          f"WITH {SAMPLES}, {EVENTS}, d AS (SELECT DISTINCT event_id, session_id, device_id, user_id, detected_at FROM decisions WHERE detected_at {_PLAUSIBLE}), "
          f"wm AS (SELECT least((SELECT max(detected_at) FROM d), (SELECT max(tm) FROM samples)) - INTERVAL 10 MINUTE AS wm), "
          f"c AS (SELECT d.event_id, count(s.pos) AS n_samples, count(s.heart_rate_bpm) / nullif(count(s.pos), 0) AS hr_ratio FROM d JOIN wm ON d.detected_at <= wm - to_microseconds({SIZE_US}) LEFT JOIN samples s ON s.session_id = d.session_id AND s.device_id = d.device_id AND s.user_id = d.user_id AND s.tm BETWEEN d.detected_at - to_microseconds({SIZE_US}) AND d.detected_at GROUP BY d.event_id) "
          "SELECT *, CASE WHEN n_samples = 0 THEN 'missing_telemetry' WHEN n_samples < 10 OR hr_ratio < 0.3 THEN 'insufficient_samples' END AS reason FROM c"),
    Query("stream_link_decisions", _linked, kinds(s="event_id", b="answered"),
          f"WITH {SAMPLES}, {EVENTS}, s AS (SELECT event_id, min(detected_at) AS t FROM suspected WHERE detected_at {_PLAUSIBLE} GROUP BY event_id), d AS (SELECT DISTINCT event_id FROM decisions WHERE responded_at {_PLAUSIBLE}), "
          f"wm AS (SELECT least((SELECT max(detected_at) FROM suspected WHERE detected_at {_PLAUSIBLE}), (SELECT max(responded_at) FROM decisions WHERE responded_at {_PLAUSIBLE})) - INTERVAL 10 MINUTE AS wm) "
          "SELECT s.event_id, d.event_id IS NOT NULL AS answered FROM s LEFT JOIN d ON d.event_id = s.event_id, wm WHERE d.event_id IS NOT NULL OR s.t + INTERVAL 300 SECOND < wm"),
    Query("score_stream", _scored, kinds(s="session_id model_version", t="window_start", i="prediction", d="probability")),
]
