"""Ordered state and the event gate on streams, against the batch operators."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.operators.windows import event_window_gate, event_windows
from pulseframe.params import CleanParams, EventWindowParams, FeatureToggles, RunParams, WindowParams
from pulseframe.plans.windows import sliding_features
from pulseframe.schemas import SAMPLES
from pulseframe.streaming import sessions as se
from pulseframe.streaming import streams as st
from tests.helpers import T0, sample_rows, samples

PARAMS = RunParams(clean=CleanParams(hr_fill_rows=4, temp_fill_rows=25), features=FeatureToggles.all_on())
def now():
    return F.lit("2026-02-01").cast("timestamp")



def uneven(n, session, start, seed):
    """Samples with missing values in long runs, implausible intervals and several samples at one instant."""
    r = random.Random(seed)
    rows = sample_rows(n, session=session, start=start, step=1.0, hr=lambda i: None if i % 23 < 9 else 60.0 + r.random() * 30,
                       ibi=lambda i: [] if i % 3 == 0 else [r.choice([180.0, 700.0, 790.5, 860.0]) for _ in range(i % 4)],
                       quality=lambda i: None if i % 5 else r.choice(["good", "fair", "poor"]), temp=lambda i: 33.0 + r.random() if i % 40 == 0 else None)
    return rows + [row[:5] + (1000 + row[5],) + row[6:7] + (71.5,) + row[8:] for row in rows[::17]]


def run(spark, folder, rows, jitter, files, params=PARAMS, idle=300.0, delay="60 seconds", **dealt):
    """Rows arrive ordered by time plus up to ``jitter`` seconds, in ``files`` files, one a trigger."""
    r = random.Random(7)
    rows = sorted(rows, key=lambda row: (row[6] + timedelta(seconds=r.random() * jitter), row[5]))
    for i in range(files):
        own = rows[i * len(rows) // files : (i + 1) * len(rows) // files]
        samples(spark, own).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in").withWatermark("timestamp", delay)
    out = se.session_features_stream(stream, params, idle, now(), **dealt)
    with se.ordered_state(spark):
        query = st.run_available(out, f"{folder}/out", f"{folder}/progress")
    assert st.dropped_rows(query) == 0
    return spark.read.schema(out.schema).parquet(f"{folder}/out").drop("closed_at")


def table(df):
    got = df.toPandas().sort_values(["session_id", "window_start", "window_index"]).reset_index(drop=True)
    return got[sorted(got)]


def same(got, want):
    import pandas as pd

    pd.testing.assert_frame_equal(table(got), table(want), rtol=1e-9, check_dtype=False)


# Far behind everything else: moves the watermark past the end of all sessions.
CLOCK = sample_rows(1, session="clock", start=T0 + timedelta(days=2))


@pytest.mark.parametrize("jitter,files", [(0, 1), (45, 1), (45, 7)])
def test_features_equal_the_batch_ones(spark, tmp_path, jitter, files):
    rows = uneven(400, "a", T0, 1) + uneven(137, "b", T0 + timedelta(seconds=60, microseconds=333), 2) + uneven(61, "c", T0, 3)
    want = sliding_features(samples(spark, rows), PARAMS, as_of=now())
    got = run(spark, str(tmp_path), rows + CLOCK, jitter, files).filter("session_id <> 'clock'")
    assert want.count() == 12 + 3 + 1 and want.filter("hrv_rmssd IS NOT NULL").count() > 10
    same(got, want)


def test_short_sessions_are_one_window_once_their_pause_is_over(spark, tmp_path):
    rows = uneven(30, "short", T0, 4) + sample_rows(1, session="one", start=T0)
    got = run(spark, str(tmp_path), rows + CLOCK, 20, 3)
    # The one-row session and the clock have too few rows: the batch operator drops the session, the stream gates the window.
    assert {(r.session_id, r.reason) for r in got.collect()} == {("short", None), ("one", "insufficient_samples")}
    same(got.filter("session_id = 'short'"), sliding_features(samples(spark, rows), PARAMS, as_of=now()))


def test_a_pause_starts_the_session_anew(spark, tmp_path):
    """Fills, intervals and windows of a stretch do not see the one before; the border is the stated pause exactly."""
    first, second = uneven(100, "s", T0, 5), uneven(90, "s", T0 + timedelta(seconds=99 + 301), 6)
    got = run(spark, str(tmp_path), first + second + CLOCK, 0, 4)
    want = sliding_features(samples(spark, first), PARAMS, as_of=now()).unionByName(sliding_features(samples(spark, second), PARAMS, as_of=now()))
    same(got.filter("session_id = 's'"), want)
    near = uneven(90, "s", T0 + timedelta(seconds=99 + 300), 6)
    got = run(spark, f"{tmp_path}/near", first + near + CLOCK, 0, 4).filter("session_id = 's'")
    # One session with a hole: batch has the same windows, among them none without rows.
    same(got, sliding_features(samples(spark, first + near), PARAMS, as_of=now()))


def test_nothing_is_final_before_the_watermark(spark, tmp_path):
    """Without later rows the last minute of the delay stays in the state."""
    got = run(spark, str(tmp_path), uneven(200, "a", T0, 1), 0, 5)
    last = max(r.window_end for r in got.collect())
    assert last.timestamp() == (T0 + timedelta(seconds=120)).timestamp()


def test_rows_without_session_or_time_belong_to_no_window(spark, tmp_path):
    rows = uneven(100, "a", T0, 8)
    lost = [row[:3] + (None,) + row[4:] for row in rows[:5]]
    got = run(spark, str(tmp_path), rows + lost + CLOCK, 0, 2).filter("session_id <> 'clock'")
    same(got, sliding_features(samples(spark, rows), PARAMS, as_of=now()))


def test_windows_apart_from_each_other(spark, tmp_path):
    """A stride beyond the size leaves samples that no window holds; they still feed the fills."""
    params = RunParams(window=WindowParams(20.0, 50.0, 5, 0.0), clean=PARAMS.clean, features=PARAMS.features)
    rows = uneven(300, "a", T0, 9)
    got = run(spark, str(tmp_path), rows + CLOCK, 30, 4, params).filter("session_id <> 'clock'")
    same(got, sliding_features(samples(spark, rows), params, as_of=now()))


def test_an_empty_stream_gives_nothing(spark, tmp_path):
    assert run(spark, str(tmp_path), [], 0, 1).count() == 0


def test_the_state_store_setting_comes_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with se.ordered_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key) == before


def test_a_session_costs_few_calls(monkeypatch):
    """One value per list in the state, whatever the rows, and one frame per release: no frame and no call for each sample or window."""
    import pandas as pd

    class State:
        def __init__(self):
            self.rows, self.calls = [], 0

        def get(self):
            self.calls += 1
            return iter(self.rows) if self.many else (self.rows or [None])[0]

        def put(self, rows):
            self.calls, self.rows = self.calls + 1, list(rows)

        def appendValue(self, row):
            self.calls, self.rows = self.calls + 1, [*self.rows, row]

        def update(self, row):
            self.put([row])

        def clear(self):
            self.put([])

    class Handle:
        def __init__(self):
            self.states = []

        def registerTimer(self, at):
            pass

        def state(self, many):
            self.states.append(State())
            self.states[-1].many = many
            return self.states[-1]

        def getValueState(self, *_):
            return self.state(False)

        def getListState(self, *_):
            return self.state(True)

    class Timers:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

    def samples_of(n):
        start = 1_700_000_000_000_000
        rows = [{"us": start + i * 1_000_000, "sequence": 0.0, "pos": float(i), "heart_rate_bpm": 60.0 + i % 7, "skin_temperature_celsius": None,
                 "quality_heart_rate": "good", "user_id": "u", "device_id": "d", **{f"ibi_{k}": 0.0 for k in se._IBI}} for i in range(n)]
        return pd.DataFrame(rows), (start // 1000) + n * 1000

    calls, frames, built = [], [], []
    real = pd.DataFrame.__init__
    for n in (200, 2000):
        handle = Handle()
        work = se._Sessions(PARAMS, 300_000_000)
        work.init(handle)
        frame, clock = samples_of(n)
        built.clear()
        monkeypatch.setattr(pd.DataFrame, "__init__", lambda self, *a, **k: (built.append(1), real(self, *a, **k))[1])
        list(work.handleInputRows(("s",), iter([frame]), Timers(0)))
        out = list(work.handleExpiredTimer(("s",), Timers(clock), None))
        frames.append(len(built))
        monkeypatch.setattr(pd.DataFrame, "__init__", real)
        assert len(out) == 1 and out[0].window_index.max() == (n - 1 - 60) // 30
        calls.append(sum(s.calls for s in handle.states))
    assert calls[0] == calls[1] <= 5 and frames == [1, 1]


@pytest.mark.parametrize("groups", [1, 3])
def test_sessions_of_a_group_do_not_meet(spark, tmp_path, groups):
    """Sessions that share a state give the batch windows each, whatever their number, their pauses and their order of arrival."""
    rows = [row for i in range(9) for row in uneven(90 + 30 * i, f"s{i}", T0 + timedelta(seconds=41 * i, microseconds=i), i)]
    again = uneven(80, "s2", T0 + timedelta(hours=3), 20) + uneven(70, "s5", T0 + timedelta(hours=3), 21)
    got = run(spark, str(tmp_path), rows + again + CLOCK, 45, 6, groups=groups).filter("session_id <> 'clock'")
    want = sliding_features(samples(spark, rows), PARAMS, as_of=now()).unionByName(sliding_features(samples(spark, again), PARAMS, as_of=now()))
    same(got, want)


def test_a_group_costs_the_calls_of_one_session():
    """Calls to the state do not grow with the sessions, and a timer that is due after the first reads nothing again."""
    import pandas as pd

    calls, due = [], []

    class State:
        rows = ()

        def get(self):
            calls.append("get")
            return iter(self.rows) if self.many else (self.rows or [None])[0]

        def put(self, rows):
            calls.append("put")
            self.rows = list(rows)

        def appendValue(self, row):
            self.put([*self.rows, row])

        def update(self, row):
            self.put([row])

        def clear(self):
            self.put([])

    class Handle:
        def getValueState(self, *_):
            state = State()
            state.many = False
            return state

        def getListState(self, *_):
            state = State()
            state.many = True
            return state

        def registerTimer(self, at):
            due.append(at)

    class Timers:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

    start, counts = 1_700_000_000_000_000, []
    for n in (2, 200):
        frame = pd.DataFrame([{"session_id": f"s{k}", "us": start + 1_000_000 * i + k, "sequence": 0.0, "pos": float(i), "heart_rate_bpm": 60.0 + k,
                               "skin_temperature_celsius": None, "quality_heart_rate": "good", "user_id": f"u{k}", "device_id": "d",
                               **{f"ibi_{m}": 0.0 for m in se._IBI}} for i in range(150) for k in range(n)])
        work = se._Sessions(PARAMS, 300_000_000)
        work.init(Handle())
        calls.clear(), due.clear()
        clock = Timers(start // 1000 + 100_000)
        list(work.handleInputRows((7,), iter([frame]), clock))
        out = pd.concat(work.handleExpiredTimer((7,), clock, None))
        counts.append(len(calls))
        # What arrived, the first row behind the watermark, and the end of the session that pauses first are waited for.
        assert [at - start // 1000 for at in due] == [0, 100_001, 399_001]
        assert out.groupby("session_id").size().tolist() == [120] * n and set(out.window_index) == {0, 1}
        assert (out.heart_rate_bpm == 60.0 + out.session_id.str[1:].astype(int)).all() and (out.session_user_id.str[1:] == out.session_id.str[1:]).all()
        assert list(work.handleExpiredTimer((7,), clock, None)) == [] and len(calls) == counts[-1] and len(due) == 3
    assert counts[0] == counts[1] <= 5


def test_event_gate_equals_the_batch_one(spark, tmp_path):
    s = samples(spark, sample_rows(300, hr=lambda i: 70.0 if i > 200 or i % 5 == 0 else None))
    far = T0 + timedelta(hours=9)
    s = s.unionByName(samples(spark, sample_rows(1, session="clock", start=far)))
    rows = [(f"e{i}", "s", "d", "u" if i % 2 else None, T0 + timedelta(seconds=20 * i)) for i in range(15)]
    rows += [("other user", "s", "d", "v", T0 + timedelta(seconds=100)), ("other device", "s", "x", "u", T0 + timedelta(seconds=100)),
             ("no session", "x", "d", "u", T0), ("before all", "s", "d", "u", T0 - timedelta(hours=1))]
    schema = "event_id string, session_id string, device_id string, user_id string, detected_at timestamp"
    events = spark.createDataFrame(rows, schema)
    s.repartition(3).write.parquet(f"{tmp_path}/s")
    events.unionByName(spark.createDataFrame([("clock", "x", "d", "u", far)], schema)).repartition(2).write.parquet(f"{tmp_path}/e")

    def source(name, schema, column):
        return spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}").withWatermark(column, "10 minutes")

    out = st.event_gate_stream(source("s", s.schema, "timestamp"), source("e", events.schema, "detected_at"))
    st.run_available(out, f"{tmp_path}/out", f"{tmp_path}/progress")
    got = spark.read.schema(out.schema).parquet(f"{tmp_path}/out")
    want = event_window_gate(events, event_windows(s, events), EventWindowParams())
    columns = ["event_id", "n_samples", "hr_ratio", "reason"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())
    assert {r.reason for r in got.collect()} == {None, "missing_telemetry", "insufficient_samples"}
