import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import contracts as ct
from pulseframe.operators.flatten import flatten_batches, unflatten
from tests.helpers import T0, ids


def decision(**own):
    doc = {"event_id": ids("e"), "device_id": ids("d"), "session_id": ids("s"), "user_id": ids("u"), "sequence": 1,
           "detected_at": T0.isoformat(), "responded_at": (T0 + timedelta(seconds=5)).isoformat(), "response": "USER_OK"}
    return {**doc, **own}


def suspected(**own):
    doc = {"event_id": ids("e"), "device_id": ids("d"), "session_id": ids("s"), "user_id": ids("u"), "sequence": 1,
           "detected_at": T0.isoformat(), "state": "SUSPECTED", "score": 0.8, "rules_version": "r1",
           "features": {"heart_rate_mean": 88.0, "rmssd_millis": 20.5, "valid_sample_ratio": 0.9, "sample_count": 60},
           "baseline": {"mean_heart_rate": 70.0}}
    return {**doc, **own}


def sample(i=0, **own):
    return {"timestamp": (T0 + timedelta(seconds=i)).isoformat(), "heart_rate_bpm": 70.0, "ibi_ms": [800.0],
            "skin_temperature_celsius": 33.0, "quality": {"heart_rate": "good", "ibi": "good"}, **own}


def batch(samples, **own):
    return {"batch_id": ids("b"), "device_id": ids("d"), "user_id": ids("u"), "session_id": ids("s"), "started_at": T0.isoformat(),
            "ended_at": (T0 + timedelta(seconds=60)).isoformat(), "sequence": 0, "samples": samples, **own}


def respell(value, style):
    def name(k):
        w = k.split("_")
        return k if style == "snake" else "".join(x.title() for x in w) if style == "pascal" else w[0] + "".join(x.title() for x in w[1:])
    if isinstance(value, dict):
        return {name(k): respell(v, style) for k, v in value.items()}
    return [respell(v, style) for v in value] if isinstance(value, list) else value


def parse(spark, kind, *docs, unknown="drop"):
    raw = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")
    return ct.parse_documents(raw, kind, unknown).collect()


@pytest.mark.parametrize("kind, doc", [("decision", decision()), ("suspected", suspected()), ("telemetry", batch([sample(0), sample(1, heart_rate_bpm=None)]))])
def test_three_spellings_are_equal(spark, kind, doc):
    rows = parse(spark, kind, *[respell(doc, s) for s in ("pascal", "camel", "snake")])
    assert rows[0] == rows[1] == rows[2] and rows[0].reason is None


def test_identity(spark):
    a, b = ids("a"), ids("b")
    one, conflict, none, shouting = parse(
        spark, "decision", decision(userId=a, UserId=None, user_id=None), decision(userId=a, UserId=b, user_id=None),
        {k: v for k, v in decision().items() if k != "user_id"}, decision(user_id=a.upper()))
    assert (one.user_id, one.reason) == (a, None)
    assert conflict.reason == "identity_mismatch"
    assert (none.user_id, none.reason) == (None, None)
    assert shouting.user_id == a


def test_last_spelling_wins(spark):
    text = json.dumps(decision(response="FIRST"))[:-1] + ', "Response": "SECOND"}'
    assert parse(spark, "decision", text)[0].response == "SECOND"


def test_uuid_forms(spark):
    u = ids("e")
    rows = parse(spark, "decision", *[decision(event_id=f) for f in (u.replace("-", ""), "{" + u + "}", "urn:uuid:" + u, "nope", 7)])
    assert [r.event_id for r in rows] == [u, u, u, None, None]
    assert [r.reason for r in rows] == [None, None, None, "invalid_document", "invalid_document"]


@pytest.mark.parametrize("doc, detail", [
    (decision(responded_at=(T0 - timedelta(seconds=1)).isoformat()), "responded_at"), (decision(response=None), "response"),
    (decision(sequence=-1), "sequence"), (decision(sequence="x"), "sequence"), (decision(detected_at="yesterday"), "detected_at"),
    (decision(user_id="me"), "user_id")])
def test_bad_decisions(spark, doc, detail):
    row = parse(spark, "decision", doc)[0]
    assert (row.reason, row.detail, row.doc_id) == ("invalid_document", detail, ids("e"))


def test_suspected_defaults_and_bounds(spark):
    plain = suspected()
    del plain["score"], plain["sequence"]
    plain["features"], plain["baseline"] = {}, {}
    ok, high, ratio, missing, null = parse(spark, "suspected", plain, suspected(score=1.2), suspected(features={"valid_sample_ratio": 1.5}),
                                           {k: v for k, v in suspected().items() if k != "baseline"}, suspected(features={"sample_count": None}))
    assert ok.reason is None and (ok.score, ok.sequence, ok.features.sample_count, ok.baseline.mean_heart_rate) == (0.0, 0, 0, 0.0)
    assert [r.detail for r in (high, ratio, missing, null)] == ["score", "features.valid_sample_ratio", "baseline", "features.sample_count"]


def test_samples_are_sanitised(spark):
    row = parse(spark, "telemetry", batch([sample(0, heart_rate_bpm=-10), sample(1, heart_rate_bpm=0), sample(2, ibi_ms=list(range(300, 320)))]))[0]
    assert row.reason is None
    assert [s.heart_rate_bpm for s in row.samples] == [None, None, 70.0]
    assert row.samples[2].ibi_ms == [float(x) for x in range(300, 316)]
    assert row.samples[0].quality.wearing_state == "unknown"


@pytest.mark.parametrize("doc, detail", [
    (batch([]), "samples.min"), (batch([sample(i) for i in range(601)]), "samples.max"),
    (batch([sample(quality={"heart_rate": "superb", "ibi": "good"})]), "samples.quality.heart_rate"),
    (batch([{k: v for k, v in sample().items() if k != "quality"}]), "samples.quality"),
    (batch([sample(ibi_ms=["a"])]), "samples.ibi_ms"), (batch([sample()], ended_at=(T0 - timedelta(seconds=1)).isoformat()), "ended_at")])
def test_bad_batches(spark, doc, detail):
    assert parse(spark, "telemetry", doc)[0].detail == detail


def test_unknown_keys(spark):
    doc = decision(received_at="x", _id="y")
    assert parse(spark, "decision", doc)[0].reason is None
    refused = parse(spark, "decision", doc, unknown="reject")[0]
    assert (refused.reason, refused.detail) == ("invalid_document", "unknown:id,unknown:receivedat")


def test_not_json(spark):
    row = parse(spark, "decision", "{broken")[0]
    assert row.reason == "invalid_document" and row.doc_id is None


def test_flatten_round_trip(spark):
    raw = spark.createDataFrame([(json.dumps(batch([sample(i) for i in range(5)])),)], "value string")
    valid, bad = ct.normalize_documents(raw, "telemetry")
    flat = flatten_batches(valid)
    again = flatten_batches(unflatten(flat))
    assert bad.isEmpty() and sorted(flat.collect()) == sorted(again.collect())
    assert flat.select(F.max("pos")).first()[0] == 4
