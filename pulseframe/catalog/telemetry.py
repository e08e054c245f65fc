"""Sources, contracts, flattening, cleaning, windows and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe import fixtures as fx
from pulseframe.catalog.base import CLEANED, FAULTY, ORDER, SAMPLES, SLIDING, Query, features_sql, kinds
from pulseframe.functions.scale import running_totals
from pulseframe.operators import clean as cl
from pulseframe.operators import contracts, flatten, windows
from pulseframe.operators.window_panes import sliding_pane_features
from pulseframe.params import CleanParams, FeatureToggles, RunParams, WindowParams
from pulseframe.plans.windows import session_features, sliding_features
from pulseframe.sources.documents import JSON_TIME
from pulseframe.sources.tables import ibi_summary

AS_OF = "2024-03-01"
PARAMS = RunParams(window=fx.WINDOW, clean=fx.CLEAN, event_window=fx.EVENT_WINDOW)
EVERYTHING = RunParams(window=fx.WINDOW, clean=fx.CLEAN, event_window=fx.EVENT_WINDOW, features=FeatureToggles.all_on())
FLAGGING = CleanParams(outlier_sigma=2.5)


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _sliding(names: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = set(names.split())
        toggles = FeatureToggles(**{n: n in chosen for n in FeatureToggles.all_on().names()})
        params = RunParams(window=fx.WINDOW, clean=fx.CLEAN, features=toggles)
        return windows.keep(sliding_features(fx.samples(spark, sf_dir), params, as_of=as_of()))
    return run


def _sliding_sql(names: str, where: str = "n_samples >= 10 AND hr_ratio >= 0.3") -> str:
    source = features_sql("windowed", "session_id, window_index, window_start, window_end, first_user, first_device",
                          "window_start", "count(*) AS n_samples, count(heart_rate_bpm) / count(*) AS hr_ratio")
    columns = ", ".join(names.split())
    return f"WITH {SLIDING} SELECT session_id, window_index, first_user AS user_id, first_device AS device_id, window_start, window_end, n_samples, hr_ratio, {columns} FROM {source} AS f WHERE {where}"


def _feature_query(name: str, names: str) -> Query:
    return Query(name, _sliding(names), kinds(s="session_id", i="window_index", d=names), _sliding_sql(names))


def _over(what: str, rows: int) -> str:
    return f"last_value({what} IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY {ORDER} ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW)"


_UNBOUNDED = f"OVER (PARTITION BY session_id ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_CENTRED = f"OVER (PARTITION BY session_id ORDER BY {ORDER} ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)"
_ROLLING = f"""WITH {SAMPLES}, {CLEANED}, r AS (SELECT session_id, pos, heart_rate_bpm, count(heart_rate_bpm) {_CENTRED} AS hr_rolling_count,
  avg(heart_rate_bpm) {_CENTRED} AS m, stddev_samp(heart_rate_bpm) {_CENTRED} AS s FROM cleaned)
SELECT session_id, pos, heart_rate_bpm, hr_rolling_count, CASE WHEN hr_rolling_count >= 3 THEN m END AS hr_rolling_mean,
  CASE WHEN hr_rolling_count >= 3 THEN s END AS hr_rolling_std FROM r"""
_ZSCORE = f"""SELECT session_id, pos, abs(heart_rate_bpm - hr_rolling_mean) / (hr_rolling_std + 1e-6) AS hr_z_score,
  coalesce(abs(heart_rate_bpm - hr_rolling_mean) / (hr_rolling_std + 1e-6) > 2.5 AND hr_rolling_count >= 5, false) AS hr_is_outlier FROM ({_ROLLING}) AS z"""


def _gappy(spark, sf_dir):
    """Long gaps on purpose, so that row limits bind."""
    return fx.samples(spark, sf_dir).withColumns({
        "heart_rate_bpm": F.when(F.col("pos") % 5 == 0, F.col("heart_rate_bpm")),
        "skin_temperature_celsius": F.when(F.col("pos") % 7 == 0, F.col("skin_temperature_celsius"))})


_TIGHT = CleanParams(hr_fill_rows=3, temp_fill_rows=5)


# --- documents ----------------------------------------------------------------------------------------------

def uuid_of(prefix: str, col: Column) -> Column:
    return F.regexp_replace(F.md5(F.concat(F.lit(prefix), col.cast("string"))), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def uuid_sql(prefix: str, col: str) -> str:
    h = f"md5('{prefix}' || CAST({col} AS VARCHAR))"
    return f"{h}[1:8] || '-' || {h}[9:12] || '-' || {h}[13:16] || '-' || {h}[17:20] || '-' || {h}[21:32]"


def _spelled(df: DataFrame, names: dict[str, Column]) -> Column:
    """The same document in one of three key spellings, by event id."""
    def words(n: str) -> list[str]:
        return n.split("_")
    snake = F.to_json(F.struct(*[c.alias(n) for n, c in names.items()]), JSON_TIME)
    camel = F.to_json(F.struct(*[c.alias(words(n)[0] + "".join(w.title() for w in words(n)[1:])) for n, c in names.items()]), JSON_TIME)
    pascal = F.to_json(F.struct(*[c.alias("".join(w.title() for w in words(n))) for n, c in names.items()]), JSON_TIME)
    return F.when(F.col("n") % 3 == 0, pascal).when(F.col("n") % 3 == 1, camel).otherwise(snake)


def decision_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision documents in mixed spellings; some carry a second user id, a missing response or a bad time."""
    e = fx.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("n"), "user_id", F.col("ts").cast("timestamp").alias("at"))
    late = F.when(F.col("n") % 17 == 0, -1).otherwise(60) * 1_000_000
    names = {
        "event_id": uuid_of("e", F.col("n")), "device_id": F.upper(uuid_of("d", F.col("user_id") % 50)),
        "user_id": F.when(F.col("n") % 10 != 0, uuid_of("u", F.floor(F.col("user_id") / 3).cast("bigint"))),
        "session_id": uuid_of("s", F.col("user_id")), "sequence": F.col("n") % 9, "detected_at": F.col("at"),
        "responded_at": F.timestamp_micros(F.unix_micros("at") + late),
        "response": F.when(F.col("n") % 13 != 0, F.lit("USER_OK")), "received_at": F.col("at"),
    }
    text = _spelled(e, names)
    clash = F.regexp_replace(text, r"^\{", '{"USER_ID":"' + "00000000-0000-0000-0000-000000000001" + '",')
    return e.select(F.when(F.col("n") % 11 == 0, clash).otherwise(text).alias("value"))


def _decision_sql(where: str) -> str:
    return f"""SELECT {uuid_sql('e', 'event_id')} AS event_id, {uuid_sql('d', 'user_id % 50')} AS device_id,
  CASE WHEN event_id % 11 = 0 THEN '00000000-0000-0000-0000-000000000001' WHEN event_id % 10 <> 0 THEN {uuid_sql('u', 'user_id // 3')} END AS user_id,
  {uuid_sql('s', 'user_id')} AS session_id, event_id % 9 AS sequence, ts AS detected_at, ts + INTERVAL 60 SECOND AS responded_at,
  'USER_OK' AS response FROM events WHERE {where}"""


# A second spelling of the user id is a conflict only when the first one has a value.
_CLASH = "(event_id % 11 = 0 AND event_id % 10 <> 0)"
_INVALID = "(event_id % 13 = 0 OR event_id % 17 = 0)"


def telemetry_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch documents with Pascal-case keys at every level; ids become UUIDs, some are cut short."""
    b = fx.batches(spark, sf_dir)
    number = F.regexp_extract("batch_id", "^[0-9]+", 0).cast("bigint")
    nested = ("array<struct<Timestamp:timestamp,HeartRateBpm:double,IbiMs:array<double>,Accelerometer:struct<x:double,y:double,z:double>,"
              "SkinTemperatureCelsius:double,AmbientTemperatureCelsius:double,Quality:struct<HeartRate:string,Ibi:string,WearingState:string>>>")
    return b.select(F.to_json(F.struct(
        F.when(number % 10 == 0, F.lit("not-a-uuid")).otherwise(uuid_of("b", F.col("batch_id"))).alias("BatchId"),
        uuid_of("d", F.col("device_id")).alias("DeviceId"), uuid_of("u", F.col("user_id")).alias("userId"),
        uuid_of("s", F.col("session_id")).alias("SessionId"), F.col("started_at").alias("StartedAt"), F.col("ended_at").alias("EndedAt"),
        F.col("sequence").alias("Sequence"), F.col("samples").cast(nested).alias("Samples")), JSON_TIME).alias("value"))


_UNKNOWN_TOP, _UNKNOWN_SAMPLE, _SHORT_ID = "number % 10 = 1", "number % 10 = 2", "number % 10 = 3"


def request_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests, each in one of three key spellings at every level; some carry a key that no request has, or a bad id."""
    r = fx.requests(spark, sf_dir).withColumn("number", F.regexp_extract("event_id", "^[0-9]+", 0).cast("bigint"))

    def spelled(spell) -> Column:
        def named(extra: str, **parts: Column) -> Column:
            return F.struct(*[v.alias(spell(k)) for k, v in parts.items()], F.when(F.expr(extra), "x").alias("debug"))

        def quality(q: Column) -> Column:
            return F.struct(*[q[k].alias(spell(k)) for k in ("heart_rate", "ibi", "wearing_state")])

        samples = F.transform("samples", lambda x: named(
            _UNKNOWN_SAMPLE, timestamp=x["timestamp"], heart_rate_bpm=x["heart_rate_bpm"], ibi_ms=x["ibi_ms"],
            skin_temperature_celsius=x["skin_temperature_celsius"], quality=quality(x["quality"])))
        event = F.when(F.expr(_SHORT_ID), "not-a-uuid").otherwise(uuid_of("e", F.col("event_id")))
        return F.to_json(named(_UNKNOWN_TOP, event_id=event, device_id=uuid_of("d", F.col("device_id")), user_id=uuid_of("u", F.col("user_id")),
                               session_id=uuid_of("s", F.col("session_id")), detected_at=F.col("detected_at"), samples=samples), JSON_TIME)

    def pascal(name: str) -> str:
        return "".join(part.capitalize() for part in name.split("_"))

    kind = F.col("number") % 3
    text = F.when(kind == 0, spelled(str)).when(kind == 1, spelled(pascal)).otherwise(spelled(lambda n: n[0] + pascal(n)[1:]))
    return r.select(text.alias("value"))


def _requests(spark, sf_dir):
    """Every strictly read request with its verdict; those that stand with what they hold."""
    got = contracts.parse_documents(request_documents(spark, sf_dir), "request", "reject")
    stands, held = F.col("reason").isNull(), ("event_id", "device_id", "user_id", "session_id", "detected_at")
    rates = F.array_compact(F.col("samples.heart_rate_bpm"))
    sums = {"n_samples": F.size("samples"), "n_hr": F.size(rates), "last_sample": F.array_max(F.col("samples.timestamp"))}
    sums |= {"hr_max": F.array_max(rates), "n_good": F.size(F.filter("samples", lambda x: x["quality"]["heart_rate"] == "good"))}
    return got.select("doc_id", "reason", "detail", *[F.when(stands, F.col(c)).alias(c) for c in held], *[F.when(stands, v).alias(c) for c, v in sums.items()])


def _exported(spark, sf_dir):
    """Samples in the order of an export, with the place of each."""
    placed = cl.order_samples(fx.samples(spark, sf_dir)).withColumns({"__at": F.monotonically_increasing_id(), "n": F.lit(1)})
    return running_totals(placed, [], ["__at"], ["n"]).withColumnRenamed("before_n", "place")


def _flat_documents(spark, sf_dir):
    valid, _ = contracts.normalize_documents(telemetry_documents(spark, sf_dir), "telemetry")
    return flatten.flatten_batches(valid)


def _identity(spark, sf_dir):
    return contracts.resolve_identity(decision_documents(spark, sf_dir))


def _batch_sizes(spark, sf_dir):
    return contracts.batch_problems(fx.faulty_batches(spark, sf_dir))


def _suspected_problems(spark, sf_dir):
    n = F.col("event_id").cast("bigint")
    rows = fx.suspected(spark, sf_dir).withColumns({
        "sequence": F.when(n % 17 == 0, -1).otherwise(F.col("sequence")),
        "features": F.when(n % 13 == 0, F.col("features").withField("valid_sample_ratio", F.lit(1.2))).otherwise(F.col("features"))})
    return contracts.suspected_problems(rows)


def _sanitized(spark, sf_dir):
    return fx.samples(spark, sf_dir).select(
        "session_id", "pos", contracts.sanitize_hr(F.col("heart_rate_bpm") - 60).alias("heart_rate_bpm"),
        F.size(contracts.truncate_ibi("ibi_ms", 2)).alias("n_ibi"))


_META = kinds(s="session_id user_id device_id", i="window_index n_samples", t="window_start window_end", d="hr_ratio")
_ALL = " ".join(FeatureToggles.all_on().names())
_STRICT = WindowParams(fx.WINDOW.size_seconds, fx.WINDOW.stride_seconds, 12, 0.85)


def _gated(spark, sf_dir):
    params = RunParams(window=_STRICT, clean=CleanParams(hr_fill_rows=0), features=FeatureToggles())
    return sliding_features(fx.samples(spark, sf_dir), params)


_RAW_WINDOWED = SLIDING.replace("ROWS BETWEEN 60 PRECEDING", "ROWS BETWEEN 0 PRECEDING").replace("WHERE n >= 10", "WHERE n >= 12")

QUERIES = [
    Query("samples_flat", lambda s, d: flatten.flatten_batches(fx.batches(s, d)).drop("pos"),
          kinds(s="batch_id user_id device_id session_id quality_heart_rate quality_ibi quality_wearing_state", i="sequence",
                t="timestamp", d="heart_rate_bpm skin_temperature_celsius"),
          f'WITH {SAMPLES} SELECT *, tm AS "timestamp" FROM samples'),
    Query("unflatten_batches", lambda s, d: fx.batches(s, d).withColumn("n", F.size("samples")).withColumn(
              "first_hr", F.get("samples", F.lit(0))["heart_rate_bpm"]),
          kinds(s="batch_id device_id user_id session_id", i="sequence n", t="started_at ended_at", d="first_hr"),
          f"WITH {SAMPLES} SELECT batch_id, device_id, user_id, session_id, sequence, count(*) AS n, min(tm) AS started_at, max(tm) AS ended_at, (list(heart_rate_bpm ORDER BY pos))[1] AS first_hr FROM samples GROUP BY batch_id, device_id, user_id, session_id, sequence"),
    Query("ibi_summary", lambda s, d: ibi_summary(fx.samples(s, d)),
          kinds(s="batch_id user_id device_id session_id quality_heart_rate quality_ibi", i="sequence ibi_count", t="timestamp",
                d="heart_rate_bpm ibi_mean_ms skin_temperature_celsius"),
          f'WITH {SAMPLES} SELECT *, tm AS "timestamp", len(ibi_ms) AS ibi_count, list_avg(ibi_ms) AS ibi_mean_ms FROM samples'),
    Query("key_spellings", lambda s, d: contracts.normalize_documents(decision_documents(s, d), "decision")[0],
          kinds(s="event_id device_id user_id session_id response", i="sequence", t="detected_at responded_at"),
          _decision_sql(f"NOT {_CLASH} AND NOT {_INVALID}")),
    Query("document_quarantine", lambda s, d: contracts.normalize_documents(decision_documents(s, d), "decision")[1],
          kinds(s="doc_id kind reason"),
          f"SELECT {uuid_sql('e', 'event_id')} AS doc_id, 'decision' AS kind, CASE WHEN {_CLASH} THEN 'identity_mismatch' ELSE 'invalid_document' END AS reason FROM events WHERE {_CLASH} OR {_INVALID}"),
    Query("reject_unknown_keys", lambda s, d: contracts.parse_documents(decision_documents(s, d), "decision", "reject").groupBy("reason").agg(F.count(F.lit(1)).alias("n")),
          kinds(s="reason", i="n"),
          f"SELECT CASE WHEN {_CLASH} THEN 'identity_mismatch' ELSE 'invalid_document' END AS reason, count(*) AS n FROM events GROUP BY 1"),
    Query("request_documents", _requests, kinds(s="doc_id reason detail event_id device_id user_id session_id", i="n_samples n_hr n_good", t="detected_at last_sample", d="hr_max"),
          f"""WITH {SAMPLES}, b AS (SELECT batch_id, session_id, device_id, user_id, CAST(session_id AS BIGINT) AS number, min(tm) + INTERVAL 4 DAY AS detected_at, count(*) AS n_samples,
  count(heart_rate_bpm) AS n_hr, max(tm) AS last_sample, max(heart_rate_bpm) AS hr_max, count(*) FILTER (WHERE quality_heart_rate = 'good') AS n_good FROM samples GROUP BY batch_id, session_id, device_id, user_id),
j AS (SELECT *, CASE WHEN {_UNKNOWN_TOP} THEN 'unknown:debug' WHEN {_UNKNOWN_SAMPLE} THEN 'samples.unknown:debug' WHEN {_SHORT_ID} THEN 'event_id' ELSE '' END AS detail FROM b)
SELECT CASE WHEN {_SHORT_ID} THEN 'not-a-uuid' ELSE {uuid_sql('e', 'batch_id')} END AS doc_id, CASE WHEN detail <> '' THEN 'invalid_document' END AS reason, detail, """
          + ", ".join(f"CASE WHEN detail = '' THEN {v} END AS {c}" for c, v in {
              "event_id": uuid_sql("e", "batch_id"), "device_id": uuid_sql("d", "device_id"), "user_id": uuid_sql("u", "user_id"), "session_id": uuid_sql("s", "session_id"),
              **{c: c for c in ("detected_at", "n_samples", "n_hr", "last_sample", "hr_max", "n_good")}}.items()) + " FROM j"),
    Query("ordered_export", _exported, kinds(s="user_id session_id", i="place sequence pos", t="timestamp"),
          f"WITH {SAMPLES} SELECT *, tm AS \"timestamp\", row_number() OVER (ORDER BY user_id, session_id, {ORDER}) - 1 AS place FROM samples"),
    Query("identity_conflicts", _identity, kinds(s="doc_id user_id", b="identity_mismatch"),
          f"SELECT {uuid_sql('e', 'event_id')} AS doc_id, CASE WHEN {_CLASH} THEN NULL WHEN event_id % 11 = 0 THEN '00000000-0000-0000-0000-000000000001' WHEN event_id % 10 <> 0 THEN {uuid_sql('u', 'user_id // 3')} END AS user_id, {_CLASH} AS identity_mismatch FROM events"),
    Query("telemetry_documents", _flat_documents,
          kinds(s="batch_id user_id device_id session_id quality_heart_rate quality_ibi", i="sequence", t="timestamp", d="heart_rate_bpm skin_temperature_celsius"),
          f"""WITH {SAMPLES} SELECT {uuid_sql('b', 'batch_id')} AS batch_id, {uuid_sql('u', 'user_id')} AS user_id, {uuid_sql('d', 'device_id')} AS device_id,
  {uuid_sql('s', 'session_id')} AS session_id, quality_heart_rate, quality_ibi, sequence, tm AS "timestamp", heart_rate_bpm, skin_temperature_celsius
  FROM samples WHERE CAST(session_id AS BIGINT) % 10 <> 0"""),
    Query("batch_invariants", _batch_sizes, kinds(s="batch_id", i="n_samples", b="size_ok order_ok sequence_ok"),
          f"WITH {SAMPLES}, {FAULTY} SELECT batch_id, n AS n_samples, n BETWEEN 1 AND 600 AS size_ok, kind <> 2 AS order_ok, kind <> 3 OR sequence <= 0 AS sequence_ok FROM faulty"),
    Query("suspected_invariants", _suspected_problems,
          kinds(s="event_id", b="score_ok ratio_ok sequence_ok"),
          "WITH " + SAMPLES.split(",\nsamples AS")[0] + ", base AS (SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS n, k / 100.0 AS score FROM ev) "
          "SELECT event_id, score BETWEEN 0 AND 1 AS score_ok, n % 13 <> 0 AS ratio_ok, n % 17 <> 0 AS sequence_ok FROM (SELECT * FROM base UNION ALL SELECT * FROM base WHERE n % 35 = 0 UNION ALL SELECT event_id, n, score + 0.5 FROM base WHERE n % 77 = 0) AS a"),
    Query("decision_invariants", lambda s, d: contracts.decision_problems(
              fx.decisions(s, d).withColumn("responded_at", F.when(F.col("event_id").cast("bigint") % 2 == 0, F.col("responded_at")).otherwise(F.timestamp_micros(F.unix_micros("detected_at") - 1)))),
          kinds(s="event_id", b="order_ok"),
          "WITH base AS (SELECT event_id AS n FROM events WHERE event_id % 49 <> 0) SELECT CAST(n AS VARCHAR) AS event_id, n % 2 = 0 AS order_ok FROM (SELECT n FROM base UNION ALL SELECT n FROM base WHERE n % 35 = 0 UNION ALL SELECT n FROM base WHERE n % 119 = 0) AS a"),
    Query("sanitize_and_truncate", _sanitized, kinds(s="session_id", i="pos n_ibi", d="heart_rate_bpm"),
          f"WITH {SAMPLES} SELECT session_id, pos, CASE WHEN heart_rate_bpm - 60 > 0 THEN heart_rate_bpm - 60 END AS heart_rate_bpm, len(ibi_ms[1:2]) AS n_ibi FROM samples"),
    Query("fill_hr_bounded", lambda s, d: cl.fill_hr(_gappy(s, d), _TIGHT), kinds(s="session_id", i="pos", d="heart_rate_bpm"),
          f"WITH {SAMPLES}, g AS (SELECT * REPLACE (CASE WHEN pos % 5 = 0 THEN heart_rate_bpm END AS heart_rate_bpm) FROM samples) SELECT session_id, pos, {_over('heart_rate_bpm', 3)} AS heart_rate_bpm FROM g"),
    Query("fill_temp_bounded", lambda s, d: cl.fill_temp(_gappy(s, d), _TIGHT), kinds(s="session_id", i="pos", d="skin_temperature_celsius"),
          f"WITH {SAMPLES}, g AS (SELECT * REPLACE (CASE WHEN pos % 7 = 0 THEN skin_temperature_celsius END AS skin_temperature_celsius) FROM samples) SELECT session_id, pos, {_over('skin_temperature_celsius', 5)} AS skin_temperature_celsius FROM g"),
    Query("fill_quality", lambda s, d: cl.fill_quality(fx.gappy_samples(s, d)), kinds(s="session_id quality_heart_rate quality_ibi quality_wearing_state", i="pos"),
          f"WITH {SAMPLES}, g AS (SELECT * REPLACE (CASE WHEN pos % 3 <> 0 THEN quality_heart_rate END AS quality_heart_rate, CASE WHEN pos % 4 <> 0 THEN quality_ibi END AS quality_ibi) FROM samples) SELECT session_id, pos, last_value(quality_heart_rate IGNORE NULLS) {_UNBOUNDED} AS quality_heart_rate, last_value(quality_ibi IGNORE NULLS) {_UNBOUNDED} AS quality_ibi, quality_wearing_state FROM g"),
    Query("rolling_hr_stats", lambda s, d: cl.rolling_stats(cl.fill_hr(fx.samples(s, d))),
          kinds(s="session_id", i="pos hr_rolling_count", d="heart_rate_bpm hr_rolling_mean hr_rolling_std"), _ROLLING),
    Query("hr_outliers", lambda s, d: cl.clean(fx.samples(s, d), FLAGGING), kinds(s="session_id", i="pos", d="hr_z_score", b="hr_is_outlier"), _ZSCORE),
    Query("cleaned_samples", lambda s, d: cl.clean(fx.samples(s, d)), kinds(s="session_id quality_heart_rate", i="pos", d="heart_rate_bpm skin_temperature_celsius"),
          f"WITH {SAMPLES}, {CLEANED} SELECT * FROM cleaned"),
    Query("sliding_windows", lambda s, d: windows.sliding_windows(cl.clean(fx.samples(s, d)), fx.WINDOW),
          kinds(s="session_id", i="window_index pos", t="window_start window_end"), f"WITH {SLIDING} SELECT * FROM windowed"),
    Query("window_metadata", lambda s, d: windows.window_metadata(windows.sliding_windows(cl.clean(fx.samples(s, d)), fx.WINDOW)), _META,
          f"WITH {SLIDING} SELECT session_id, first_user AS user_id, first_device AS device_id, window_index, window_start, window_end, count(*) AS n_samples, count(heart_rate_bpm) / count(*) AS hr_ratio FROM windowed GROUP BY ALL"),
    Query("sliding_window_gate", _gated, kinds(s="session_id reason", i="window_index n_samples", d="hr_ratio"),
          f"WITH {_RAW_WINDOWED}, m AS (SELECT session_id, window_index, count(*) AS n_samples, count(heart_rate_bpm) / count(*) AS hr_ratio FROM windowed GROUP BY ALL) SELECT *, CASE WHEN n_samples < 12 THEN 'insufficient_samples' WHEN hr_ratio < 0.85 THEN 'insufficient_heart_rate' END AS reason FROM m"),
    Query("session_windows", lambda s, d: session_features(fx.samples(s, d), EVERYTHING, as_of=as_of()), kinds(s="session_id", d=_ALL),
          f"WITH {SAMPLES} SELECT * FROM " + features_sql("samples", "session_id", "TIMESTAMP '1970-01-01'") + " AS f"),
    _feature_query("features_hr", "hr_mean hr_std hr_min hr_max hr_slope_bpm_per_min"),
    _feature_query("features_hrv", "hrv_rmssd hrv_sdnn hrv_pnn50"),
    _feature_query("features_ibi_coverage", "ibi_available ibi_coverage_ratio"),
    _feature_query("features_temp", "skin_temp_mean skin_temp_std"),
    _feature_query("features_quality", "quality_good_ratio quality_fair_ratio quality_poor_ratio valid_sample_ratio"),
    _feature_query("features_temporal", "window_duration_seconds sample_count last_sample_age_seconds movement_magnitude_mean movement_variance_mean"),
    Query("features_all_windows", lambda s, d: windows.keep(sliding_features(fx.samples(s, d), EVERYTHING, as_of=as_of())),
          _META | kinds(d=_ALL), _sliding_sql(_ALL)),
    Query("features_by_panes", lambda s, d: windows.keep(sliding_pane_features(fx.samples(s, d), EVERYTHING, as_of=as_of())),
          _META | kinds(d=_ALL), _sliding_sql(_ALL)),
]
