import json
from datetime import timedelta

import pytest

from pulseframe import fixtures as fx
from pulseframe.operators import contracts as ct
from pulseframe.operators.windows import event_windows
from pulseframe.params import EventWindowParams
from pulseframe.sources import documents, tables
from pulseframe.streaming import streams as st
from tests.helpers import T0, sample_rows, samples
from tests.test_contracts import batch, sample


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_samples_round_trip(spark, tmp_path, fmt):
    s = samples(spark, sample_rows(20, hr=lambda i: float("nan") if i == 3 else 70.0))
    path = f"{tmp_path}/samples.{fmt}"
    tables.write_table(s, path)
    got = {r.pos: r for r in tables.read_samples(spark, path).collect()}
    assert got[3].heart_rate_bpm is None and got[4].ibi_ms == [804.0, 810.0] and got[4].timestamp == got[3].timestamp + timedelta(seconds=1)


def test_other_formats_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_samples(spark, f"{tmp_path}/x.xlsx")
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), f"{tmp_path}/x.xlsx")
    with pytest.raises(ValueError):
        documents.read_documents(spark, str(tmp_path), "other")


def test_documents_keep_microseconds(spark, sf, tmp_path):
    b = fx.batches(spark, sf).limit(5)
    documents.write_documents(b, f"{tmp_path}/docs")
    raw = documents.read_documents(spark, f"{tmp_path}/docs", "telemetry")
    parsed = ct.parse_documents(raw, "telemetry")
    assert sorted(r.started_at for r in parsed.collect()) == sorted(r.started_at for r in b.collect())


def test_dataset_is_partitioned_by_split(spark, tmp_path):
    ds = spark.createDataFrame([("a", "train"), ("b", "test")], "event_id string, split string")
    tables.save_dataset(ds, spark.createDataFrame([("x", "decision", "r")], "doc_id string, kind string, reason string"), str(tmp_path))
    back, ledger = tables.load_dataset(spark, str(tmp_path))
    assert sorted((r.event_id, r.split) for r in back.collect()) == [("a", "train"), ("b", "test")] and ledger.count() == 1
    assert (tmp_path / "dataset" / "split=train").exists()


def run(spark, tmp_path, stream, name):
    st.run_available(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-progress")
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}")


def test_stream_survives_several_files(spark, tmp_path):
    """Documents arriving in several batches; the bad one is left out, the restart adds only what is new."""
    src = tmp_path / "in"
    src.mkdir()
    def arrive(i, doc):
        (src / f"{i}.json").write_text(json.dumps(doc) + "\n")
    for i in range(3):
        arrive(i, batch([sample(60 * i + j) for j in range(60)], batch_id=f"00000000-0000-0000-0000-00000000000{i}"))
    arrive(3, batch([]))
    stream = lambda: st.stream_samples(spark, str(src), files_per_trigger=1)
    assert run(spark, tmp_path, stream(), "flat").count() == 180
    arrive(4, batch([sample(500)], batch_id="00000000-0000-0000-0000-000000000009"))
    assert run(spark, tmp_path, stream(), "flat").count() == 181


def test_event_join_stream_equals_batch(spark, tmp_path):
    s = samples(spark, sample_rows(300))
    events = spark.createDataFrame(
        [(f"e{i}", "s", "d", "u" if i % 2 else None, T0 + timedelta(seconds=40 * i)) for i in range(6)] + [("gone", "x", "d", "u", T0)],
        "event_id string, session_id string, device_id string, user_id string, detected_at timestamp")
    s.repartition(3).write.parquet(f"{tmp_path}/s")
    events.repartition(2).write.parquet(f"{tmp_path}/e")
    def source(name, schema, column):
        return spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}").withWatermark(column, "1 hour")
    joined = st.event_windows_stream(source("s", s.schema, "timestamp"), source("e", events.schema, "detected_at"), EventWindowParams())
    got = run(spark, tmp_path, joined.select("event_id", "pos"), "joined")
    want = event_windows(s, events).select("event_id", "pos")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0


def test_event_join_stream_keeps_unmatched_events(spark, tmp_path):
    s = samples(spark, sample_rows(60) + sample_rows(1, session="later", start=T0 + timedelta(hours=5)))
    events = spark.createDataFrame([("hit", "s", "d", "u", T0 + timedelta(seconds=30)), ("miss", "x", "d", "u", T0), ("far", "x", "d", "u", T0 + timedelta(hours=5))],
                                   "event_id string, session_id string, device_id string, user_id string, detected_at timestamp")
    s.write.parquet(f"{tmp_path}/s")
    events.write.parquet(f"{tmp_path}/e")
    a = spark.readStream.schema(s.schema).parquet(f"{tmp_path}/s").withWatermark("timestamp", "1 second")
    b = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/e").withWatermark("detected_at", "1 second")
    got = run(spark, tmp_path, st.event_windows_stream(a, b, EventWindowParams(), "left_outer").select("event_id", "pos"), "outer").toPandas()
    assert got[got.event_id == "miss"]["pos"].isna().all() and (got.event_id == "miss").sum() == 1
    assert (got.event_id == "hit").sum() == 31


def test_run_batches_hands_over_each_batch(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/in")
    seen = []
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    st.run_batches(stream, lambda df, i: seen.append(df.count()), f"{tmp_path}/progress")
    assert sum(seen) == 10


def test_ibi_summary_of_nothing_is_null(spark):
    rows = tables.ibi_summary(samples(spark, sample_rows(2, ibi=lambda i: [] if i else [800.0, 900.0]))).orderBy("timestamp").collect()
    assert [(r.ibi_count, r.ibi_mean_ms) for r in rows] == [(2, 850.0), (0, None)]


def _distinct_events(spark, tmp_path, name, files, shifted):
    """Ids of the deduplicated stream over ``files`` files in time order, and how many rows came behind the watermark."""
    from pyspark.sql import functions as F

    folder, start = f"{tmp_path}/{name}", 1_700_000_000
    rows = [(str(i), start + 3600 * i + (10 * 365 * 86_400 if shifted and i % 9 == 4 else 0)) for i in range(40)]
    rows = [r for r in rows for _ in range(2)]
    for part in range(files):
        own = rows[part * len(rows) // files : (part + 1) * len(rows) // files]
        spark.createDataFrame(own, "event_id string, s long").select(
            "event_id", F.timestamp_seconds("s").alias("detected_at")).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema("event_id string, detected_at timestamp").option("maxFilesPerTrigger", 1).parquet(folder)
    now = F.timestamp_seconds(F.lit(start + 3600 * 40))
    query = st.run_available(st.dedup_events_stream(stream, now=now), f"{folder}-out", f"{folder}-progress")
    ids = sorted(int(r["event_id"]) for r in spark.read.parquet(f"{folder}-out").collect())
    _, late = st.split_future(spark.read.parquet(folder), now=now)
    return ids, st.dropped_rows(query), late.count()


def test_one_and_many_triggers_give_the_same_events(spark, tmp_path):
    once = _distinct_events(spark, tmp_path, "once", 1, False)
    assert once == (list(range(40)), 0, 0)
    assert _distinct_events(spark, tmp_path, "many", 8, False) == once


def test_rows_from_the_future_do_not_empty_a_stream(spark, tmp_path):
    shifted = [i for i in range(40) if i % 9 == 4]
    ids, dropped, late = _distinct_events(spark, tmp_path, "future", 8, True)
    assert ids == [i for i in range(40) if i not in shifted] and dropped == 0 and late == 2 * len(shifted)


def test_event_stream_keeps_ranges_parallel(spark, sf, tmp_path):
    """Each trigger reads one whole time range, from as many files as the table has splits."""
    fx.table(spark, sf, "events").repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    events = fx.table(spark, str(tmp_path), "events").toPandas()
    low, step = events.ts.min(), (events.ts.max() - events.ts.min()) / fx.TRIGGERS
    ranges = [int(((events.ts >= low + i * step) & ((events.ts < low + (i + 1) * step) | (i == fx.TRIGGERS - 1))).sum()) for i in range(fx.TRIGGERS)]
    stream = fx.event_stream(spark, str(tmp_path))
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == ranges
    files = spark.read.json(f"{tmp_path}/progress/sources/0/*").filter("path IS NOT NULL").select("path", "batchId")
    assert all(r["count"] > 1 for r in files.groupBy("batchId").count().collect())


def test_sinks_are_idempotent_by_batch(spark, tmp_path):
    """A batch that is handed over again changes neither the sinks nor the ledger; all input rows are somewhere."""
    from pyspark.sql import functions as F

    from pulseframe.streaming import sinks

    folder, now = f"{tmp_path}/sinks", F.timestamp_seconds(F.lit(1_700_000_000))
    split = sinks.split_events(now=now)
    rows = spark.range(20).select(F.col("id").cast("string").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 20_000).alias("detected_at"))
    def state():
        out = sinks.Sinks(folder)
        schema = "event_id string, detected_at timestamp"
        return (sorted(r.event_id for r in out.part(spark, "kept", schema).collect()),
                sorted((r.event_id, r.reason) for r in out.part(spark, "set_aside", f"{schema}, reason string").collect()),
                sorted(map(tuple, out.ledger(spark).collect()), key=str))
    assert state() == ([], [], [])
    for batch, part in ((0, rows.filter("event_id < 10")), (1, rows.filter("event_id >= 10"))):
        sinks.write_batch(split(part), {"set_aside": ["from_the_future"]}, folder, batch)
    once = state()
    assert len(once[0]) + len(once[1]) == 20 and len(once[1]) == 15
    assert set(once[2]) == {("kept", None, 5, 0), ("set_aside", "from_the_future", 5, 0), ("set_aside", "from_the_future", 10, 1)}
    sinks.write_batch(split(rows.filter("event_id >= 10")), {"set_aside": ["from_the_future"]}, folder, 1)
    assert state() == once


def test_entry_without_a_package_that_only_llm_needs(monkeypatch):
    import importlib

    import __spark_entry__ as contract

    def broken(name):
        raise ModuleNotFoundError(f"No module named 'elsewhere'", name="elsewhere")

    monkeypatch.setattr(importlib, "import_module", broken)
    with pytest.warns(UserWarning, match="elsewhere"):
        assert contract._optional("pulseframe.llm.queries") is None
