"""Registered queries: a Spark callable, the same question in SQL, and the output columns with their kinds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Both engines round doubles the same way; the small shift keeps exact halves away from the rounding edge.
_SHIFT, _DIGITS = 1.23e-8, 6


@dataclass(frozen=True)
class Query:
    """``kinds``: column -> d double, i integer, s text, b boolean, t time (as microseconds since the epoch)."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    kinds: dict[str, str]
    sql: str | None = None

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return shape(self.run(spark, sf_dir), self.kinds)

    def oracle(self) -> str | None:
        return wrap(self.sql, self.kinds) if self.sql else None


def kinds(**groups: str) -> dict[str, str]:
    """kinds(s="a b", d="c") -> {"a": "s", "b": "s", "c": "d"}."""
    return {name: kind for kind, names in groups.items() for name in names.split()}


def shape(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    cast = {
        "d": lambda c: F.round(c.cast("double") + F.lit(_SHIFT), _DIGITS) + F.lit(0.0),
        "i": lambda c: c.cast("bigint"), "s": lambda c: c.cast("string"), "b": lambda c: c.cast("boolean"),
        "t": F.unix_micros,
    }
    return df.select(*[cast[kind](F.col(name)).alias(name) for name, kind in columns.items()])


def wrap(sql: str, columns: dict[str, str]) -> str:
    cast = {
        "d": 'round(CAST("{c}" AS DOUBLE) + CAST({s} AS DOUBLE), {n}) + CAST(0 AS DOUBLE)', "i": 'CAST("{c}" AS BIGINT)',
        "s": 'CAST("{c}" AS VARCHAR)', "b": 'CAST("{c}" AS BOOLEAN)', "t": 'epoch_us("{c}")',
    }
    parts = ", ".join(f'{cast[k].format(c=c, s=_SHIFT, n=_DIGITS)} AS "{c}"' for c, k in columns.items())
    return f"SELECT {parts} FROM ({sql}) AS q"


# --- shared SQL ---------------------------------------------------------------------------------------------

SIZE_US, STRIDE_US = 604_800_000_000, 302_400_000_000
ORDER = "tm, sequence, pos"

SAMPLES = """ev AS (SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM events),
samples AS (SELECT
  CAST(e.user_id AS VARCHAR) || '-' || CAST(weekofyear(e.ts) AS VARCHAR) AS batch_id,
  CAST(e.user_id // 3 AS VARCHAR) AS user_id, CAST(e.user_id % 50 AS VARCHAR) AS device_id, CAST(e.user_id AS VARCHAR) AS session_id,
  CAST(weekofyear(e.ts) AS BIGINT) AS sequence,
  row_number() OVER (PARTITION BY e.user_id, weekofyear(e.ts) ORDER BY e.ts, e.event_id) - 1 AS pos, e.ts AS tm,
  CASE WHEN e.event_type = 'error' THEN NULL ELSE 40 + e.value END AS heart_rate_bpm,
  CASE WHEN e.event_type IN ('view', 'click') THEN [CAST(600 + k AS DOUBLE), CAST(620 + 2 * k AS DOUBLE), CAST(25 * k AS DOUBLE)]
       ELSE CAST([] AS DOUBLE[]) END AS ibi_ms,
  CASE WHEN e.event_type = 'signup' THEN NULL ELSE CAST(30 + k / 20.0 AS DOUBLE) END AS skin_temperature_celsius,
  CASE WHEN e.event_type IN ('click', 'purchase') THEN 'good' WHEN e.event_type = 'view' THEN 'fair'
       WHEN e.event_type = 'error' THEN 'poor' ELSE 'unknown' END AS quality_heart_rate,
  CASE WHEN e.event_type IN ('view', 'click') THEN 'good' ELSE 'unknown' END AS quality_ibi,
  'unknown' AS quality_wearing_state
  FROM ev e)"""

# Documents with stated faults: 0 empty, 1 repeated beyond 600 samples, 2 ended before started, 3 negative sequence.
FAULTY = """faulty AS (SELECT batch_id, kind, sequence, CASE kind WHEN 0 THEN 0 WHEN 1 THEN n * CAST(ceil(601 / CAST(n AS DOUBLE)) AS BIGINT) ELSE n END AS n
  FROM (SELECT batch_id, sequence, count(*) AS n, (CAST(session_id AS BIGINT) + 7 * sequence) % 11 AS kind FROM samples GROUP BY batch_id, sequence, session_id) AS a)"""

CLEANED = f"""cleaned AS (SELECT * EXCLUDE (heart_rate_bpm, skin_temperature_celsius), heart_rate_bpm AS hr_raw,
  last_value(heart_rate_bpm IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY {ORDER} ROWS BETWEEN 60 PRECEDING AND CURRENT ROW) AS heart_rate_bpm,
  last_value(skin_temperature_celsius IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY {ORDER} ROWS BETWEEN 300 PRECEDING AND CURRENT ROW) AS skin_temperature_celsius
  FROM samples)"""

WINDOWED = f"""bounds AS (SELECT session_id, min(tm) AS s0, max(tm) AS s1, count(*) AS n, arg_min(user_id, (tm, sequence, pos)) AS first_user,
  arg_min(device_id, (tm, sequence, pos)) AS first_device, epoch_us(max(tm)) - epoch_us(min(tm)) AS dur FROM samples GROUP BY session_id),
steps AS (SELECT *, unnest(range(CASE WHEN dur < {SIZE_US} THEN 1 ELSE (dur - {SIZE_US}) // {STRIDE_US} + 1 END)) AS window_index
  FROM bounds WHERE n >= 10),
spans AS (SELECT session_id, first_user, first_device, window_index, dur < {SIZE_US} AS short,
  CASE WHEN dur < {SIZE_US} THEN s0 ELSE s0 + to_microseconds(window_index * {STRIDE_US}) END AS window_start,
  CASE WHEN dur < {SIZE_US} THEN s1 ELSE s0 + to_microseconds(window_index * {STRIDE_US} + {SIZE_US}) END AS window_end FROM steps),
windowed AS (SELECT c.*, w.window_index, w.window_start, w.window_end, w.first_user, w.first_device FROM spans w JOIN cleaned c
  ON c.session_id = w.session_id AND c.tm >= w.window_start AND (w.short OR c.tm < w.window_end))"""


def features_sql(source: str, keys: str, anchor: str, extra: str = "") -> str:
    """All window features grouped by ``keys``; HRV from whole ordered lists, independent of the Spark route."""
    more = f"{extra}," if extra else ""
    return f"""(SELECT * EXCLUDE (kept, diffs),
  CASE WHEN len(kept) >= 3 THEN sqrt(list_avg(list_transform(diffs, lambda d: d * d))) END AS hrv_rmssd,
  CASE WHEN len(kept) >= 3 THEN list_aggregate(kept, 'stddev_samp') END AS hrv_sdnn,
  CASE WHEN len(kept) >= 3 THEN 100.0 * len(list_filter(diffs, lambda d: abs(d) > 50)) / len(diffs) END AS hrv_pnn50
  FROM (SELECT *, list_transform(range(1, len(kept)), lambda i: kept[i + 1] - kept[i]) AS diffs
  FROM (SELECT {keys}, {more} avg(heart_rate_bpm) AS hr_mean,
    CASE WHEN count(heart_rate_bpm) = 1 THEN 0.0 ELSE stddev_samp(heart_rate_bpm) END AS hr_std,
    min(heart_rate_bpm) AS hr_min, max(heart_rate_bpm) AS hr_max,
    CASE WHEN count(heart_rate_bpm) = 1 THEN 0.0 ELSE regr_slope(heart_rate_bpm, (epoch_us(tm) - epoch_us({anchor})) / 6e7) END AS hr_slope_bpm_per_min,
    list_filter(flatten(list(ibi_ms ORDER BY {ORDER})), lambda x: x >= 250 AND x <= 2000) AS kept,
    max(CASE WHEN len(ibi_ms) > 0 THEN 1 ELSE 0 END) AS ibi_available,
    avg(CASE WHEN len(ibi_ms) > 0 THEN 1.0 ELSE 0.0 END) AS ibi_coverage_ratio,
    avg(skin_temperature_celsius) AS skin_temp_mean,
    CASE WHEN count(skin_temperature_celsius) = 1 THEN 0.0 ELSE stddev_samp(skin_temperature_celsius) END AS skin_temp_std,
    avg(CASE WHEN quality_heart_rate = 'good' THEN 1.0 ELSE 0.0 END) AS quality_good_ratio,
    avg(CASE WHEN quality_heart_rate = 'fair' THEN 1.0 ELSE 0.0 END) AS quality_fair_ratio,
    avg(CASE WHEN quality_heart_rate = 'poor' THEN 1.0 ELSE 0.0 END) AS quality_poor_ratio,
    avg(CASE WHEN heart_rate_bpm IS NOT NULL AND quality_heart_rate IS DISTINCT FROM 'poor' THEN 1.0 ELSE 0.0 END) AS valid_sample_ratio,
    (epoch_us(max(tm)) - epoch_us(min(tm))) / 1e6 AS window_duration_seconds, count(*) AS sample_count,
    (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(tm))) / 1e6 AS last_sample_age_seconds,
    CAST(NULL AS DOUBLE) AS movement_magnitude_mean, CAST(NULL AS DOUBLE) AS movement_variance_mean
    FROM {source} GROUP BY {keys}) AS a) AS b)"""


EVENTS = """base AS (SELECT event_id AS n, CAST(event_id AS VARCHAR) AS event_id, CAST(user_id % 50 AS VARCHAR) AS device_id,
  CAST(user_id // 3 AS VARCHAR) AS user_id, CAST(user_id AS VARCHAR) AS session_id, CAST(weekofyear(ts) AS BIGINT) AS sequence,
  ts + CASE WHEN event_id % 105 = 0 THEN INTERVAL 3650 DAY ELSE INTERVAL 0 DAY END AS tm, k FROM ev e),
sus0 AS (SELECT *, CASE WHEN n % 91 = 0 THEN tm + INTERVAL 1 SECOND ELSE tm END AS detected_at, CAST(k / 100.0 AS DOUBLE) AS score FROM base),
suspected AS (SELECT * FROM sus0 UNION ALL SELECT * FROM sus0 WHERE n % 35 = 0
  UNION ALL SELECT * REPLACE (score + 0.5 AS score, tm AS detected_at) FROM sus0 WHERE n % 77 = 0),
dec0 AS (SELECT *, tm AS detected_at, tm + INTERVAL 60 SECOND AS responded_at,
  CASE k % 4 WHEN 0 THEN 'SUPPORT_REQUESTED' WHEN 1 THEN 'ACTIVITY_CONFIRMED' WHEN 2 THEN ' user_ok ' ELSE 'BREATHING_HELPED' END AS response
  FROM base WHERE n % 49 <> 0),
decisions AS (SELECT * FROM dec0 UNION ALL SELECT * FROM dec0 WHERE n % 35 = 0
  UNION ALL SELECT * REPLACE ('USER_OK_2' AS response) FROM dec0 WHERE n % 119 = 0),
sus_ids AS (SELECT event_id, count(DISTINCT (detected_at, score)) AS versions FROM suspected GROUP BY event_id),
sus AS (SELECT DISTINCT s.* FROM suspected s JOIN sus_ids USING (event_id) WHERE versions = 1),
dec_ids AS (SELECT event_id, count(DISTINCT response) AS versions FROM decisions GROUP BY event_id),
dec AS (SELECT DISTINCT d.* FROM decisions d JOIN dec_ids USING (event_id) WHERE versions = 1)"""

# Each event window is cleaned alone, so fills restart at the event.
EVENT_FEATURES = f"""ew AS (SELECT d.event_id, d.detected_at - to_microseconds({SIZE_US}) AS window_start, s.* FROM dec d JOIN samples s
  ON s.session_id = d.session_id AND s.device_id = d.device_id AND s.user_id = d.user_id
  AND s.tm >= d.detected_at - to_microseconds({SIZE_US}) AND s.tm <= d.detected_at),
ewc AS (SELECT * EXCLUDE (heart_rate_bpm, skin_temperature_celsius), heart_rate_bpm AS hr_raw,
  last_value(heart_rate_bpm IGNORE NULLS) OVER (PARTITION BY event_id ORDER BY {ORDER} ROWS BETWEEN 60 PRECEDING AND CURRENT ROW) AS heart_rate_bpm,
  last_value(skin_temperature_celsius IGNORE NULLS) OVER (PARTITION BY event_id ORDER BY {ORDER} ROWS BETWEEN 300 PRECEDING AND CURRENT ROW) AS skin_temperature_celsius
  FROM ew),
ef AS {features_sql("ewc", "event_id, window_start", "window_start", "count(*) AS n_samples, avg(CASE WHEN hr_raw IS NULL THEN 0.0 ELSE 1.0 END) AS hr_ratio")}"""

JUDGED = """judged AS (SELECT d.*, f.* EXCLUDE (event_id, window_start), s.event_id IS NOT NULL AS has_suspected_event, s.score AS detector_score,
  s.k AS sk, CASE upper(trim(d.response)) WHEN 'SUPPORT_REQUESTED' THEN 1 WHEN 'ACTIVITY_CONFIRMED' THEN 0 WHEN 'USER_OK' THEN 0 END AS target_support_requested,
  CASE upper(trim(d.response)) WHEN 'SUPPORT_REQUESTED' THEN 'SUPPORT_REQUESTED' WHEN 'ACTIVITY_CONFIRMED' THEN 'PHYSICAL_ACTIVITY'
    WHEN 'USER_OK' THEN 'SELF_REPORTED_OK' END AS response_category,
  CASE WHEN s.event_id IS NOT NULL AND s.detected_at <> d.detected_at THEN 'event_mismatch'
    WHEN f.n_samples IS NULL THEN 'missing_telemetry' WHEN f.n_samples < 10 OR f.hr_ratio < 0.3 THEN 'insufficient_samples'
    WHEN upper(trim(d.response)) NOT IN ('SUPPORT_REQUESTED', 'ACTIVITY_CONFIRMED', 'USER_OK') THEN 'unsupported_response' END AS reason
  FROM dec d LEFT JOIN sus s ON s.event_id = d.event_id LEFT JOIN ef f ON f.event_id = d.event_id),
ds AS (SELECT * FROM judged WHERE reason IS NULL),
ledger AS (SELECT event_id AS doc_id, 'decision' AS kind, reason FROM judged WHERE reason IS NOT NULL
  UNION ALL SELECT event_id, 'suspected', 'duplicate_suspected_conflict' FROM sus_ids WHERE versions > 1
  UNION ALL SELECT event_id, 'decision', 'duplicate_decision_conflict' FROM dec_ids WHERE versions > 1
  UNION ALL SELECT event_id, 'suspected', 'missing_decision' FROM sus WHERE event_id NOT IN (SELECT event_id FROM dec))"""

TRUTH = ",\n".join([SAMPLES, EVENTS, EVENT_FEATURES, JUDGED])
SLIDING = ",\n".join([SAMPLES, CLEANED, WINDOWED])
SCORED = """scored AS (SELECT d.doc_id, d.lang, d.source, l.quality AS label, (d.n_chars % 997) / CAST(997 AS DOUBLE) AS score
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
