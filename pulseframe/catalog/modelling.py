"""Splitting, preparation, classifiers, metrics and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe import fixtures as fx
from pulseframe.catalog.base import ORDER, SAMPLES, SCORED, SIZE_US, SLIDING, TRUTH, Query, features_sql, kinds
from pulseframe.catalog.labelling import dataset, stored
from pulseframe.catalog.telemetry import EVERYTHING, PARAMS, as_of
from pulseframe.operators import classifiers as clf
from pulseframe.operators import metrics as mt
from pulseframe.operators import prep, split
from pulseframe.operators.labels import TARGET
from pulseframe.operators.windows import keep
from pulseframe.params import FALLBACK_METRICS, DummyParams, RunParams, SplitParams
from pulseframe.plans import scoring
from pulseframe.plans.training import evaluate_model, train_on_windows, train_protocol
from pulseframe.plans.windows import sliding_features
from pulseframe.schemas import FEATURE_SCHEMA
from pulseframe.session import cut_lineage
from pulseframe.sources.models import SavedModel, load_model, save_model

USER_SPLIT = SplitParams(group_by="user")
_ONE_SHARE = "CAST(0.2 AS DOUBLE)"


def _split_sql(rows: str, group: str) -> str:
    """Rows with their split: groups in order of their draw, test first, then validation."""
    return f"""gs AS (SELECT DISTINCT {group} AS g, md5('42|' || CAST({group} AS VARCHAR)) AS h FROM {rows}),
gr AS (SELECT g, row_number() OVER (ORDER BY h) AS rn, count(*) OVER () AS n FROM gs),
gn AS (SELECT *, ceil({_ONE_SHARE} * n) AS n_test FROM gr),
gv AS (SELECT g, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + ceil(CAST(0.125 AS DOUBLE) * (n - n_test)) THEN 'val' ELSE 'train' END AS split FROM gn),
split AS (SELECT r.*, v.split FROM {rows} r JOIN gv v ON v.g = r.{group})"""


def _windows(spark, sf_dir):
    """Kept sliding windows with a label by session."""
    return keep(sliding_features(fx.samples(spark, sf_dir), PARAMS)).withColumn("label", (F.col("session_id").cast("bigint") % 3 == 0).cast("int"))


def _user_split(spark, sf_dir):
    return split.group_split(stored(spark, sf_dir).dataset, USER_SPLIT)


def _train(spark, sf_dir):
    ds = _user_split(spark, sf_dir)
    return ds, ds.filter("split = 'train'")


def _imputed(spark, sf_dir):
    ds, train = _train(spark, sf_dir)
    return prep.impute(ds, prep.fit_impute(train, FEATURE_SCHEMA))


def _standardized(spark, sf_dir):
    ds, train = _train(spark, sf_dir)
    return prep.apply_prep(ds, prep.fit_prep(train))


def _selected(spark, sf_dir):
    """One row per usable feature, with the number of train rows that have it."""
    ds, train = _train(spark, sf_dir)
    empty = train.withColumn("skin_temp_mean", F.lit(None).cast("double"))
    names = prep.select_features(empty)
    return empty.select(F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value")) for n in names])).alias("r")).groupBy("r.feature").agg(F.count("r.value").alias("n"))


def _dummy(strategy, constant=0):
    def run(spark, sf_dir):
        ds, train = _train(spark, sf_dir)
        model = clf.fit_dummy(train, FEATURE_SCHEMA, DummyParams(strategy, constant))
        return clf.predict(ds, model)
    return run


def _scored(spark, sf_dir):
    return fx.scored_labels(spark, sf_dir)


def _scored_split(spark, sf_dir):
    docs = split.group_split(_scored(spark, sf_dir).withColumn("text_id", F.col("doc_id")), SplitParams(), "text_id")
    return mt.predict_at(docs, 0.5)


def _select_threshold(spark, sf_dir):
    found, source = mt.select_threshold(_scored_split(spark, sf_dir))
    return found.withColumn("source", F.lit(source))


def _protocol(spark, sf_dir, ds=None):
    return train_protocol(dataset(spark, sf_dir) if ds is None else ds, PARAMS)


def _protocol_metrics(spark, sf_dir):
    return _protocol(spark, sf_dir).metrics


def _variant(spark, sf_dir):
    r = _protocol(spark, sf_dir)
    return r.selection.withColumns({"selected": F.lit(r.selected), "source": F.lit(r.threshold_source)})


def _model(spark, sf_dir, ds=None):
    """Trained, saved and loaded again, so that scoring uses the stored form."""
    result, path = _protocol(spark, sf_dir, ds), fx.scratch(spark)
    save_model(spark, result.saved, path)
    return load_model(spark, path)


def _infinite(spark, sf_dir):
    ds = dataset(spark, sf_dir).select("event_id", *FEATURE_SCHEMA)
    return ds.withColumn("hr_mean", F.when(F.col("event_id").cast("bigint") % 3 == 0, F.lit(float("inf"))).otherwise(F.col("hr_mean")))


def _score_features(spark, sf_dir):
    """Trained and scored on one stored dataset; the columns that only audits read are left out before it is stored again for training."""
    ds = stored(spark, sf_dir).dataset.select("event_id", "user_id", TARGET, *FEATURE_SCHEMA)
    return scoring.score_features(ds.select("event_id", *FEATURE_SCHEMA), _model(spark, sf_dir, ds))[0]


def _window_model(spark, sf_dir):
    return evaluate_model(train_on_windows(_windows(spark, sf_dir), RunParams(window=fx.WINDOW)), key="session_id")


def _scored_windows_metrics(spark, sf_dir):
    model = _model(spark, sf_dir)
    scored = scoring.score_batches(fx.batches(spark, sf_dir), model)
    labels = scored.select("session_id", "window_index", (F.col("session_id").cast("bigint") % 3 == 0).cast("int").alias("label"))
    return scoring.scored_metrics(cut_lineage(scored), labels, ["session_id", "window_index"])


def _labelled_scores(spark, sf_dir):
    """Metrics of scored rows that meet their labels only by key."""
    rows = _scored(spark, sf_dir)
    scored = rows.select("doc_id", F.col("score").alias("probability"), (F.col("score") >= 0.5).cast("int").alias("prediction"))
    return scoring.scored_metrics(cut_lineage(scored), rows.select("doc_id", "label"), ["doc_id"])


def _prior_model(spark, sf_dir):
    """The prior baseline saved, loaded and applied: its scores can be stated in SQL."""
    ds, train = _train(spark, sf_dir)
    made = SavedModel(clf.fit_dummy(train, FEATURE_SCHEMA, DummyParams("prior")), "1.0", TARGET, 0.25, "val", tuple(FEATURE_SCHEMA), PARAMS)
    path = fx.scratch(spark)
    save_model(spark, made, path)
    return scoring.score_features(ds.select("event_id", *FEATURE_SCHEMA), load_model(spark, path))[0]


_F = " ".join(FEATURE_SCHEMA)
_CONF = "count(*) FILTER (label = 0 AND p = 0) AS tn, count(*) FILTER (label = 0 AND p = 1) AS fp, count(*) FILTER (label = 1 AND p = 0) AS fn, count(*) FILTER (label = 1 AND p = 1) AS tp"
_RATES = """tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, (tp + tn) / nullif(tn + fp + fn + tp, 0) AS accuracy,
  CASE WHEN tp + fp > 0 AND tp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END AS f1, tn / nullif(tn + fp, 0) AS specificity, 1 - tn / nullif(tn + fp, 0) AS false_positive_rate,
  (tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2 AS balanced_accuracy"""


def _ranks_sql(source: str, by: str) -> str:
    """Pairwise definition of AUC and step definition of average precision over distinct scores."""
    return f"""sc AS (SELECT {by}, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM {source} GROUP BY {by}, score),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY {by}) AS np, sum(neg) OVER (PARTITION BY {by}) AS nn
  FROM sc WINDOW w AS (PARTITION BY {by} ORDER BY score DESC)),
steps AS (SELECT *, coalesce(lag(tp) OVER w, 0) AS tp0, coalesce(lag(fp) OVER w, 0) AS fp0 FROM cum WINDOW w AS (PARTITION BY {by} ORDER BY score DESC)),
ranks AS (SELECT {by}, CASE WHEN max(np) > 0 AND max(nn) > 0 THEN sum((fp - fp0) * (tp + tp0) / 2) / max(CAST(np AS DOUBLE) * nn) END AS roc_auc,
  CASE WHEN max(np) > 0 AND max(nn) > 0 THEN sum((tp - tp0) / CAST(np AS DOUBLE) * tp / (tp + fp)) END AS average_precision FROM steps GROUP BY {by}),
f1s AS (SELECT {by}, score, 2 * (tp / (tp + fp)) * (tp / np) / (tp / (tp + fp) + tp / np + CAST(1e-10 AS DOUBLE)) AS f1 FROM cum WHERE np > 0),
best AS (SELECT {by}, score AS threshold, f1 FROM f1s QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY f1 DESC, score) = 1)"""


_TRUE_SPLIT = f"WITH {TRUTH}, {_split_sql('ds', 'user_id')}"
_DOC_SPLIT = f"WITH {SCORED}, docs AS (SELECT *, doc_id AS text_id FROM scored), {_split_sql('docs', 'text_id')}"
_DRAW = "CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)"
_MONITORED = ("hrv_rmssd", "hrv_sdnn", "ibi_available", "ibi_coverage_ratio")
_FILL = {f: "0" if f in prep.ZERO_FILLED else f"(SELECT quantile_cont({f}, 0.5) FROM split WHERE split = 'train')" for f in FEATURE_SCHEMA}
_FILLED = ", ".join(f"coalesce({f}, {v}) AS {f}" for f, v in _FILL.items())
_INDICATED = ", ".join(f"CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END AS {f}_was_nan" for f in _MONITORED)
_INPUTS = [*FEATURE_SCHEMA, *[f"{f}_was_nan" for f in _MONITORED]]
_SCALED = ", ".join(f"(i.{c} - m.m_{c}) / CASE WHEN m.s_{c} < 1e-12 THEN 1 ELSE m.s_{c} END AS z_{c}" for c in _INPUTS)
_MOMENTS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _INPUTS)
_METRICS = "accuracy precision recall f1 roc_auc average_precision balanced_accuracy specificity false_positive_rate"

_REQUESTS = f"""blocks AS (SELECT *, batch_id AS doc FROM samples),
anchors AS (SELECT doc, min(tm) + INTERVAL 4 DAY AS t FROM blocks GROUP BY doc),
rq AS (SELECT b.* EXCLUDE (batch_id), b.batch_id AS event_id, a.t - to_microseconds({SIZE_US}) AS window_start, heart_rate_bpm AS hr_raw FROM blocks b JOIN anchors a ON a.doc = b.doc AND b.tm BETWEEN a.t - to_microseconds({SIZE_US}) AND a.t),
rqc AS (SELECT * EXCLUDE (heart_rate_bpm, skin_temperature_celsius),
  last_value(heart_rate_bpm IGNORE NULLS) OVER (PARTITION BY event_id ORDER BY tm, pos ROWS BETWEEN 60 PRECEDING AND CURRENT ROW) AS heart_rate_bpm,
  last_value(skin_temperature_celsius IGNORE NULLS) OVER (PARTITION BY event_id ORDER BY tm, pos ROWS BETWEEN 300 PRECEDING AND CURRENT ROW) AS skin_temperature_celsius FROM rq)"""

QUERIES = [
    Query("group_split_user", _user_split, kinds(s="event_id user_id split"), f"{_TRUE_SPLIT} SELECT * FROM split"),
    Query("group_split_session", lambda s, d: split.group_split(_windows(s, d)), kinds(s="session_id split", i="window_index"),
          f"WITH {SLIDING}, w AS (SELECT session_id, window_index FROM windowed GROUP BY ALL HAVING count(*) >= 10 AND count(heart_rate_bpm) / count(*) >= 0.3), {_split_sql('w', 'session_id')} SELECT * FROM split"),
    Query("split_report", lambda s, d: split.split_report(_user_split(s, d)), kinds(s="split", i="n_rows n_groups n_negative n_positive"),
          f"{_TRUE_SPLIT} SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_groups, count(*) FILTER (target_support_requested = 0) AS n_negative, count(*) FILTER (target_support_requested = 1) AS n_positive FROM split GROUP BY split"),
    Query("group_overlap", lambda s, d: split.group_overlap(_user_split(s, d)), kinds(s="pair", i="n_common"),
          f"{_TRUE_SPLIT}, g AS (SELECT DISTINCT user_id, split FROM split) SELECT a || '_vs_' || b AS pair, (SELECT count(*) FROM g x JOIN g y ON x.user_id = y.user_id WHERE x.split = a AND y.split = b) AS n_common FROM (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) AS p(a, b)"),
    Query("select_features", _selected, kinds(s="feature", i="n"),
          f"{_TRUE_SPLIT} SELECT u.f AS feature, count(u.v) AS n FROM split, (VALUES " + ", ".join(f"('{f}', CAST({f} AS DOUBLE))" for f in FEATURE_SCHEMA if f != "skin_temp_mean") + ") AS u(f, v) WHERE split = 'train' GROUP BY 1 HAVING count(u.v) > 0"),
    Query("nan_indicators", lambda s, d: prep.nan_indicators(dataset(s, d)), kinds(s="event_id", i=" ".join(f"{f}_was_nan" for f in _MONITORED)),
          f"WITH {TRUTH} SELECT event_id, {_INDICATED} FROM ds"),
    Query("impute_median", _imputed, kinds(s="event_id", d=_F), f"{_TRUE_SPLIT} SELECT event_id, {_FILLED} FROM split"),
    Query("standardize", _standardized, kinds(s="event_id", d=" ".join(f"z_{c}" for c in _INPUTS)),
          f"{_TRUE_SPLIT}, i AS (SELECT event_id, split, {_FILLED}, {_INDICATED} FROM split), m AS (SELECT {_MOMENTS} FROM i WHERE split = 'train') SELECT event_id, {_SCALED} FROM i, m"),
    Query("class_weights", lambda s, d: clf.class_weights(_train(s, d)[1]), kinds(i=f"{TARGET} n", d="weight"),
          f"{_TRUE_SPLIT} SELECT target_support_requested, count(*) AS n, (SELECT count(*) FROM split WHERE split = 'train') / CAST(2 * count(*) AS DOUBLE) AS weight FROM split WHERE split = 'train' GROUP BY 1"),
    Query("prior_baseline", _dummy("prior"), kinds(s="event_id", i="prediction", d="probability"),
          f"{_TRUE_SPLIT}, p AS (SELECT avg(target_support_requested) AS p FROM split WHERE split = 'train') SELECT event_id, p AS probability, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction FROM split, p"),
    Query("constant_baseline", _dummy("constant", 1), kinds(s="event_id", i="prediction", d="probability"), f"{_TRUE_SPLIT} SELECT event_id, 1 AS probability, 1 AS prediction FROM split"),
    Query("stratified_baseline", _dummy("stratified"), kinds(s="event_id", i="prediction", d="probability"),
          f"{_TRUE_SPLIT}, p AS (SELECT avg(target_support_requested) AS p FROM split WHERE split = 'train'), u AS (SELECT event_id, CASE WHEN {_DRAW} < p THEN 1 ELSE 0 END AS hit FROM split, p) SELECT event_id, hit AS probability, hit AS prediction FROM u"),
    Query("uniform_baseline", _dummy("uniform"), kinds(s="event_id", i="prediction", d="probability"),
          f"{_TRUE_SPLIT} SELECT event_id, 0.5 AS probability, CASE WHEN {_DRAW} < 0.5 THEN 1 ELSE 0 END AS prediction FROM split"),

    Query("confusion", lambda s, d: mt.confusion(mt.predict_at(_scored(s, d), 0.5), ["lang"]), kinds(s="lang", i="tn fp fn tp"),
          f"WITH {SCORED}, p AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM scored) SELECT lang, {_CONF} FROM p GROUP BY lang"),
    Query("metrics_threshold", lambda s, d: mt.evaluate_at(_scored(s, d), 0.3, ["lang"]), kinds(s="lang", i="tn fp fn tp n_samples n_positive", d="threshold " + _METRICS),
          f"WITH {SCORED}, p AS (SELECT *, CASE WHEN score >= CAST(0.3 AS DOUBLE) THEN 1 ELSE 0 END AS p FROM scored), c AS (SELECT lang, {_CONF} FROM p GROUP BY lang), {_ranks_sql('scored', 'lang')} "
          f"SELECT c.*, tn + fp + fn + tp AS n_samples, fn + tp AS n_positive, 0.3 AS threshold, {_RATES}, roc_auc, average_precision FROM c JOIN ranks USING (lang)"),
    Query("metric_availability", lambda s, d: mt.evaluate_at(_scored(s, d), 2.0, ["source"]).select("source", *[F.col("available")[m].alias(m) for m in _METRICS.split()]),
          kinds(s="source", b=_METRICS),
          f"WITH {SCORED} SELECT source, true AS accuracy, false AS precision, sum(label) > 0 AS recall, false AS f1, sum(label) > 0 AND sum(1 - label) > 0 AS roc_auc, sum(label) > 0 AND sum(1 - label) > 0 AS average_precision, sum(label) > 0 AND sum(1 - label) > 0 AS balanced_accuracy, sum(1 - label) > 0 AS specificity, sum(1 - label) > 0 AS false_positive_rate FROM scored GROUP BY source"),
    Query("roc_auc", lambda s, d: mt.ranking_metrics(mt.ranked_scores(_scored(s, d))).select("roc_auc"), kinds(d="roc_auc"),
          f"WITH {SCORED}, s1 AS (SELECT *, 1 AS one FROM scored), {_ranks_sql('s1', 'one')} SELECT * FROM ranks"),
    Query("average_precision", lambda s, d: mt.ranking_metrics(mt.ranked_scores(_scored(s, d), ["lang"]), ["lang"]), kinds(s="lang", d="average_precision"),
          f"WITH {SCORED}, {_ranks_sql('scored', 'lang')} SELECT * FROM ranks"),
    Query("best_f1_threshold", lambda s, d: mt.best_f1_threshold(mt.ranked_scores(_scored(s, d), ["lang"]), ["lang"]), kinds(s="lang", d="threshold f1"),
          f"WITH {SCORED}, {_ranks_sql('scored', 'lang')} SELECT * FROM best"),
    Query("select_threshold", _select_threshold, kinds(s="source", d="threshold"),
          f"{_DOC_SPLIT}, v AS (SELECT *, 1 AS one FROM split WHERE split = 'val'), {_ranks_sql('v', 'one')} SELECT 'val' AS source, threshold FROM best"),
    Query("metrics_by_split", lambda s, d: mt.evaluate_splits(_scored_split(s, d)), kinds(s="split", i="tn fp fn tp n_samples", d=_METRICS),
          f"{_DOC_SPLIT}, p AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM split), c AS (SELECT split, {_CONF} FROM p GROUP BY split), {_ranks_sql('split', 'split')} SELECT c.*, tn + fp + fn + tp AS n_samples, {_RATES}, roc_auc, average_precision FROM c JOIN ranks USING (split)"),

    Query("reject_feature_rows", lambda s, d: scoring.check_feature_rows(_infinite(s, d))[1], kinds(s="event_id infinite_features"),
          f"WITH {TRUTH} SELECT event_id, 'hr_mean' AS infinite_features FROM ds WHERE CAST(event_id AS BIGINT) % 3 = 0"),
    Query("request_features", lambda s, d: scoring.request_features(fx.requests(s, d), EVERYTHING).drop("last_sample_age_seconds"),
          kinds(s="event_id reason", i="n_samples", d="hr_ratio " + _F),
          f"WITH {SAMPLES}, {_REQUESTS}, f AS {features_sql('rqc', 'event_id, window_start', 'window_start', 'count(*) AS n_samples, count(hr_raw) / count(*) AS hr_ratio')} "
          "SELECT *, CASE WHEN n_samples < 10 OR hr_ratio < 0.3 THEN 'insufficient_samples' END AS reason FROM f"),
    Query("train_protocol", _protocol_metrics, kinds(s="model split", i="tn fp fn tp", d=_METRICS)),
    Query("select_variant", _variant, kinds(s="model selected source", d="threshold f1")),
    Query("train_on_windows", _window_model, kinds(s="split", i="tn fp fn tp", d=_METRICS)),
    Query("score_features", _score_features, kinds(s="event_id model_version target", i="prediction", d="support_probability threshold")),
    Query("score_events", lambda s, d: scoring.score_events(fx.requests(s, d), _model(s, d))[0], kinds(s="event_id", i="prediction", d="support_probability threshold")),
    Query("score_batches", lambda s, d: scoring.score_batches(fx.batches(s, d), _model(s, d)), kinds(s="session_id user_id device_id", t="window_start window_end", i="window_index n_samples prediction", d="probability")),
    Query("score_samples", lambda s, d: scoring.score_samples(fx.samples(s, d), _model(s, d)), kinds(s="session_id user_id device_id", t="window_start window_end", i="n_samples prediction", d="probability")),
    Query("scored_metrics", _scored_windows_metrics, kinds(i="tn fp fn tp n_samples", d=_METRICS)),
    Query("score_events_rejects", lambda s, d: scoring.score_events(fx.requests(s, d), _model(s, d))[1], kinds(s="event_id reason"),
          f"WITH {SAMPLES}, {_REQUESTS}, f AS (SELECT event_id, count(*) AS n, count(hr_raw) / count(*) AS r FROM rqc GROUP BY event_id) "
          "SELECT event_id, 'insufficient_samples' AS reason FROM f WHERE n < 10 OR r < 0.3"),
    Query("scored_metrics_documents", _labelled_scores, kinds(i="tn fp fn tp n_samples", d=_METRICS),
          f"WITH {SCORED}, s1 AS (SELECT *, 1 AS one FROM scored), p AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM s1), c AS (SELECT one, {_CONF} FROM p GROUP BY one), {_ranks_sql('s1', 'one')} "
          f"SELECT c.*, tn + fp + fn + tp AS n_samples, {_RATES}, roc_auc, average_precision FROM c JOIN ranks USING (one)"),
    Query("metric_subset", lambda s, d: mt.evaluate_at(_scored(s, d), 0.3, ["lang"], mt.configured(None)), kinds(s="lang", i="tn fp fn tp", d=" ".join(FALLBACK_METRICS)),
          f"WITH {SCORED}, p AS (SELECT *, CASE WHEN score >= CAST(0.3 AS DOUBLE) THEN 1 ELSE 0 END AS p FROM scored), c AS (SELECT lang, {_CONF} FROM p GROUP BY lang), {_ranks_sql('scored', 'lang')} "
          f"SELECT c.*, {_RATES}, roc_auc, average_precision FROM c JOIN ranks USING (lang)"),
    Query("model_round_trip", _prior_model, kinds(s="event_id model_version target", i="prediction", d="support_probability threshold"),
          f"{_TRUE_SPLIT}, pr AS (SELECT avg(target_support_requested) AS p FROM split WHERE split = 'train') SELECT event_id, '1.0' AS model_version, '{TARGET}' AS target, "
          "CASE WHEN p >= 0.25 THEN 1 ELSE 0 END AS prediction, p AS support_probability, 0.25 AS threshold FROM split, pr"),
]
