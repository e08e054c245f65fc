import json
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe import fixtures as fx
from pulseframe.operators import event_panes, labels as lb
from pulseframe.operators import parity, qa, validate
from pulseframe.params import QaParams, RunParams
from pulseframe.plans import ground_truth
from pulseframe.plans.ground_truth import build_ground_truth, ground_truth_from_documents
from pulseframe.schemas import DECISION, SUSPECTED
from tests.helpers import T0, ids, sample_rows, samples
from tests.test_contracts import batch, decision, respell, sample, suspected

PARAMS = RunParams(event_window=fx.EVENT_WINDOW)
EXPECTED = {  # computed independently in SQL
    "0.001": dict(kept=619, event_mismatch=9, missing_telemetry=8, insufficient_samples=148, unsupported_response=188,
                  missing_decision=26, duplicate_suspected_conflict=13, duplicate_decision_conflict=7),
    "0.01": dict(kept=6008, event_mismatch=80, missing_telemetry=71, insufficient_samples=1535, unsupported_response=2029,
                 missing_decision=252, duplicate_suspected_conflict=130, duplicate_decision_conflict=72),
}


@pytest.mark.parametrize("size", sorted(EXPECTED))
def test_reason_counts(spark, size):
    d = f"/root/testdata/sf{size}"
    truth = build_ground_truth(fx.samples(spark, d), fx.suspected(spark, d), fx.decisions(spark, d), PARAMS, materialize=True)
    got = {r.reason: r.n for r in qa.exclusions_by_reason(truth.exclusions).collect()}
    assert {"kept": truth.dataset.count(), **got} == EXPECTED[size]


def test_row_order_does_not_matter(spark, sf):
    def build(shuffle):
        frames = [fx.samples(spark, sf), fx.suspected(spark, sf), fx.decisions(spark, sf)]
        return build_ground_truth(*[f.orderBy(F.rand(shuffle)) for f in frames] if shuffle else frames, PARAMS).dataset.select("event_id", *PARAMS.features.names())
    assert sorted(build(None).collect()) == sorted(build(11).collect())


def docs(spark, *items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "value string")


def telemetry(n=61, first=0):
    return batch([sample(i) for i in range(first, first + n)], batch_id=ids(f"b{first}"), ended_at=(T0 + timedelta(seconds=600)).isoformat())


AT = (T0 + timedelta(seconds=60)).isoformat()


def at_t(make, **own):
    late = {"responded_at": (T0 + timedelta(seconds=90)).isoformat()} if make is decision else {}
    return make(detected_at=AT, **late, **own)


def test_documents_end_to_end(spark):
    truth = ground_truth_from_documents(
        docs(spark, respell(telemetry(), "pascal")), docs(spark, respell(at_t(suspected), "camel")),
        docs(spark, at_t(decision, response=" support_requested "), at_t(decision, event_id=ids("x"), userId=ids("other")),
             at_t(decision, event_id=ids("far"), ) | {"detected_at": (T0 + timedelta(days=1)).isoformat(), "responded_at": (T0 + timedelta(days=2)).isoformat()},
             at_t(decision, event_id=ids("odd"), response="BREATHING_HELPED"), {"event_id": "bad"}), RunParams())
    row = truth.dataset.first()
    assert (row.event_id, row.response, row.target_support_requested, row.response_category) == (ids("e"), " support_requested ", 1, "SUPPORT_REQUESTED")
    assert row.sample_count == 61 and row.detector_score == 0.8 and row.watch_features_snapshot.heart_rate_mean == 88.0
    assert {(r.doc_id, r.reason) for r in truth.exclusions.collect()} == {
        (ids("x"), "identity_mismatch"), ("bad", "invalid_document"), (ids("far"), "missing_telemetry"), (ids("odd"), "unsupported_response")}


def test_batch_order_does_not_matter(spark):
    one, two = telemetry(30), telemetry(31, 30)
    a, b = (ground_truth_from_documents(docs(spark, *order), docs(spark, at_t(suspected)), docs(spark, at_t(decision))).dataset.first() for order in ((one, two), (two, one)))
    assert a == b and a.sample_count == 61


def test_conflicting_copies_leave_entirely(spark):
    s = [at_t(suspected), at_t(suspected, score=0.3)]
    truth = ground_truth_from_documents(docs(spark, telemetry()), docs(spark, *s), docs(spark, at_t(decision), respell(at_t(decision), "pascal")))
    row = truth.dataset.first()
    assert row.has_suspected_event is False and row.detector_score is None
    assert [r.reason for r in truth.exclusions.collect()] == ["duplicate_suspected_conflict"]
    summary = {r.key: r.n for r in truth.summary().collect()}
    assert (summary["n_rows"], summary["duplicate_conflicts"], summary["n_exclusions"]) == (1, 1, 1)


def test_mismatch_comes_before_missing_telemetry(spark):
    moved = at_t(suspected) | {"detected_at": (T0 + timedelta(seconds=61)).isoformat()}
    truth = ground_truth_from_documents(docs(spark, batch([sample()], session_id=ids("elsewhere"))), docs(spark, moved), docs(spark, at_t(decision)))
    assert [r.reason for r in truth.exclusions.collect()] == ["event_mismatch"]


def test_user_mismatch_only_when_both_known(spark):
    def matches(a, b):
        dec = spark.createDataFrame([("e", "d", a, "s", 0, T0, T0, "USER_OK")], DECISION)
        sus = spark.createDataFrame([("e", "d", b, "s", 0, T0, "x", 0.1, "r", None, None)], SUSPECTED)
        return lb.attach_suspected(dec, sus).select(lb.suspected_matches()).first()[0]
    assert [matches(a, b) for a, b in (("u", "u"), ("u", "v"), (None, "v"), ("u", None))] == [True, False, True, True]


def test_session_labels_must_be_complete(spark):
    w = spark.createDataFrame([("a",), ("b",)], "session_id string")
    labels = spark.createDataFrame([("a", 1)], "session_id string, label int")
    with pytest.raises(ValueError, match="b"):
        lb.require_labels(lb.session_labels(w, labels))


# --- validation ---------------------------------------------------------------------------------------------

def issues(spark, kind=None, **change):
    rows = sample_rows(20, ibi=lambda i: [60000 / 70.0], hr=change.get("hr", lambda i: 70.0), quality=change.get("quality", lambda i: "good"), step=change.get("step", 1.0))
    if "ibi" in change:
        rows = [(*r[:8], change["ibi"](r[5]), *r[9:]) for r in rows]
    from pulseframe.operators.flatten import unflatten
    got = validate.validate_batches(unflatten(samples(spark, rows)))
    return sorted((r.check, r.n) for r in validate.issue_counts(got).collect())


def test_batch_checks_fire_once(spark):
    assert issues(spark) == []
    assert issues(spark, step=400.0) == [("large_gap", 1)]
    assert issues(spark, hr=lambda i: 250.0 if i == 3 else 70.0, ibi=lambda i: []) == [("hr_out_of_range", 1)]
    assert issues(spark, hr=lambda i: 70.0 if i < 9 else None) == [("low_hr_availability", 1)]
    assert issues(spark, quality=lambda i: "poor" if i < 7 else "good") == [("high_poor_ratio", 1)]
    assert issues(spark, hr=lambda i: 60.0, ibi=lambda i: [500.0] if i == 2 else []) == [("ibi_inconsistent", 1)]
    assert issues(spark, step=-1.0) != [] and issues(spark, step=-1.0)[0][0] == "unsorted_samples"


def test_empty_and_oversized_batches(spark):
    from pulseframe.schemas import TELEMETRY
    one = (T0, 70.0, [], None, 33.0, None, ("good", "good", "onBody"))
    df = spark.createDataFrame([("empty", "d", "u", "s", T0, T0, 0, []), ("big", "d", "u", "s", T0, T0, 0, [one] * 601)], TELEMETRY)
    got = {(r.key, r.level, r.check) for r in validate.validate_batches(df).collect()}
    assert ("empty", "error", "no_samples") in got and ("big", "warning", "too_many_samples") in got


def test_frame_checks(spark):
    s = samples(spark, sample_rows(20))
    assert validate.is_valid(validate.validate_samples(s)) and validate.validate_samples(s).isEmpty()
    assert [r.key for r in validate.validate_samples(s.drop("heart_rate_bpm", "user_id")).collect()] == ["heart_rate_bpm", "user_id"]
    assert not validate.is_valid(validate.validate_samples(s.withColumn("user_id", F.when(F.col("pos") != 3, F.col("user_id")))))
    swapped = s.withColumn("pos", F.when(F.col("pos") == 4, 15).when(F.col("pos") == 15, 4).otherwise(F.col("pos")).cast("long"))
    assert [(r.check, r.key) for r in validate.validate_samples(swapped).collect()] == [("timestamps_not_monotonic", "s")]


# --- reports ------------------------------------------------------------------------------------------------

def small_dataset(spark, watch_mean=80.0, delta=None, baseline=70.0, hr=72.0, target=1, rmssd=None):
    snapshot = (watch_mean, None, None, delta, None, None, None, None, 1.0, 0, 60)
    rows = [("e", "u", "d", "s", T0, target, snapshot, (30, baseline, 0.0, 0), hr, 60.0, 1.0, rmssd, 0.0)]
    from pulseframe.schemas import BASELINE, SNAPSHOT
    return spark.createDataFrame(rows, f"event_id string, user_id string, device_id string, session_id string, detected_at timestamp, target_support_requested int, watch_features_snapshot {SNAPSHOT.simpleString()}, watch_baseline_snapshot {BASELINE.simpleString()}, hr_mean double, sample_count double, valid_sample_ratio double, hrv_rmssd double, ibi_available double")


def test_parity_statuses(spark):
    got = {r.watch_field: r for r in parity.parity_rows(small_dataset(spark)).collect()}
    assert (got["heart_rate_mean"].status, got["heart_rate_mean"]["diff"]) == ("diverging", 8.0)
    assert got["sample_count"].status == "match" and got["rmssd_millis"].status == "both_missing" and len(got) == 7
    assert parity.parity_rows(small_dataset(spark, watch_mean=72.3)).filter("watch_field = 'heart_rate_mean'").first().status == "match"
    assert parity.parity_rows(small_dataset(spark, watch_mean=None)).filter("watch_field = 'heart_rate_mean'").first().status == "watch_missing"
    derived = parity.parity_derived(small_dataset(spark, delta=2.0)).first()
    assert (derived.ml_value, derived.status) == (2.0, "match")
    assert parity.parity_rows(small_dataset(spark, hr=0.0)).filter("watch_field = 'heart_rate_mean'").first().rel_diff is None
    loose = {"heart_rate_mean": (10.0, 0.0)}
    assert parity.parity_rows(small_dataset(spark), loose).filter("watch_field = 'heart_rate_mean'").first().status == "match"


def test_qa_warnings(spark):
    ds = small_dataset(spark)
    got = {(r.warning, r.subject) for r in qa.qa_warnings(ds).collect()}
    assert got == {("single_class", "dataset"), ("high_missingness", "hrv_rmssd"), ("no_ibi", "dataset"), ("small_dataset", "dataset")}
    empty = {r.warning for r in qa.qa_warnings(ds.limit(0)).collect()}
    assert empty == {"empty_dataset", "small_dataset"}
    assert qa.feature_missingness(ds.limit(0)).isEmpty()
    both = ds.unionByName(small_dataset(spark, target=0, rmssd=20.0))
    row = qa.feature_missingness(both, QaParams()).filter("feature = 'hrv_rmssd'").first()
    assert (row.n_missing, row.missing_ratio, row.flagged) == (1, 0.5, False)


def test_readiness_lists_every_failure(spark):
    with pytest.raises(qa.NotReady) as err:
        qa.require_ready(small_dataset(spark))
    assert all(word in str(err.value) for word in ("both_classes", "enough_users", "enough_rows")) and "aligned" not in str(err.value)


def test_ids_are_dealt_by_rows_unless_one_has_too_many_copies(spark, monkeypatch):
    for module in (event_panes, ground_truth):
        monkeypatch.setattr(module, "ROWS_PER_TASK", 50)
    one_each = [(f"e{i}", float(i)) for i in range(300)]
    rows = spark.createDataFrame([*one_each, ("e7", 7.0), ("e8", 8.5), (None, 1.0)], "event_id string, score double")
    copies = spark.createDataFrame([*one_each, *[("e9", 9.0)] * 60], "event_id string, score double")
    spread, folded = ground_truth.dealt_events(rows, copies)
    assert (spread.rdd.getNumPartitions(), folded.rdd.getNumPartitions()) == (8, copies.rdd.getNumPartitions())
    kept, conflicts = lb.dedup_events(spread)
    assert sorted(kept.collect(), key=str) == sorted([r for r in [*one_each, (None, 1.0)] if r[0] != "e8"], key=str)
    assert [r.event_id for r in conflicts.collect()] == ["e8"]
    assert sorted(lb.dedup_events(folded)[0].collect()) == sorted(one_each)

    truth = build_ground_truth(samples(spark, sample_rows()), fx.suspected(spark, "/root/testdata/sf0.001"), fx.decisions(spark, "/root/testdata/sf0.001"), PARAMS)
    plan = truth.exclusions._jdf.queryExecution().executedPlan().toString()
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(event_id#\d+L?, (\d+)\)", plan)]
    assert dealt and min(dealt) > int(spark.conf.get("spark.sql.shuffle.partitions"))
