"""Features of session windows on a stream, equal to the batch ones: samples are put in order by state, not by a sort.

Sessions are dealt by a hash into groups, and one state per group holds the samples that the watermark has not passed and, by session, the last
values that may still be filled forward, the last plausible interval, and the cleaned samples of windows that are still open: what a key costs
beyond its rows, some milliseconds a trigger, does not grow with the number of sessions. A timer at the watermark releases samples in their order,
so rows that arrive out of order within the delay give the same result. A window is handed on at once with all its rows when a sample
at or behind its end is released; the features are then the same grouped aggregation as in batch, final in the same trigger.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pulseframe.functions.columns import ibi_summary_struct, micros
from pulseframe.operators.features import window_features
from pulseframe.operators.windows import SLIDING_KEYS, metadata_aggregates, name_owner, sliding_gate
from pulseframe.params import RunParams
from pulseframe.schemas import SAMPLE_ORDER

def _fields(**kinds: str) -> T.StructType:
    """_fields(double="a b", string="c"), in the order given."""
    out = T.StructType()
    for kind, names in kinds.items():
        for name in names.split():
            out.add(name, kind)
    return out


_IBI = {"n": "long", "d1": "double", "d2": "double", "ss": "double", "over": "long", "first": "double", "last": "double"}
_READ = " ".join(f"ibi_{n}" for n in _IBI) + " heart_rate_bpm skin_temperature_celsius"
_PENDING = ["us", "sequence", "pos", *_READ.split(), "quality_heart_rate", "user_id", "device_id"]
_HELD = _fields(long="us", double=f"{_READ} prev_value prev_us", string="quality_heart_rate")
_OUT = T.StructType([*_fields(timestamp="closed_at", string="session_id session_user_id session_device_id", long="window_index start_us end_us"),
                     *_HELD])
# A list of rows, or what is known of all sessions of a group, is one value of the state: each access to the state is a call.
_PACKED = _fields(binary="packed")
#: Rows handed on in one frame, about.
_FRAME = 50_000
#: Groups that sessions are dealt into.
GROUPS = 4_096
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@dataclass
class _Stretch:
    """What is known of a session between two samples, and the cleaned samples of its open windows."""

    start: int
    last: int
    user_id: str | None
    device_id: str | None
    next_window: int = 0
    hr_age: int = 0
    temp_age: int = 0
    quality: str | None = None
    hr: float | None = None
    temp: float | None = None
    prev_value: float | None = None
    prev_us: float | None = None
    held: list[tuple] = field(default_factory=list)


class _Sessions(StatefulProcessor):
    """The sessions of a group, or of a key that is itself one when rows name none. Rows are handled one by one as tuples, without a frame for each session."""

    def __init__(self, params: RunParams, idle_us: int):
        self.size, self.stride = micros(params.window.size_seconds), micros(params.window.stride_seconds)
        self.hr_rows, self.temp_rows, self.idle = params.clean.hr_fill_rows, params.clean.temp_fill_rows, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("sessions", _PACKED)
        self.pending = handle.getListState("pending", _PACKED)
        self.released = set()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """Keep what arrives; the timer, which runs after all input of the trigger, releases it."""
        first = None
        for part in rows:
            sessions = part["session_id"].tolist() if "session_id" in part else [key[0]] * len(part)
            columns = [part[name].tolist() for name in _PENDING]
            arrived = [tuple(None if v is None or v != v else v for v in row) for row in zip(*columns)]
            self.pending.appendValue((pickle.dumps((sessions, arrived)),))
            low = min(columns[0])
            first = low if first is None else min(first, low)
        if first is not None:
            self.handle.registerTimer(_millis(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Several timers of a group may be due; the first releases all that the others would.
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        if (key, clock) in self.released:
            return
        self.released.add((key, clock))
        known, waiting = self.known.get(), defaultdict(list)
        for (packed,) in self.pending.get():
            for session, row in zip(*pickle.loads(packed)):
                waiting[session].append(row)
        stretches, later, out = pickle.loads(known[0]) if known else {}, ([], []), []
        waited = bool(waiting)
        for session in dict.fromkeys([*stretches, *waiting]):
            rows = sorted(waiting.pop(session, ()), key=_place)
            cut = bisect_right(rows, clock, key=_time)
            stretch = self._released(session, stretches.pop(session, None), rows[:cut], clock, out)
            if stretch:
                stretches[session] = stretch
            later[0].extend([session] * (len(rows) - cut))
            later[1].extend(rows[cut:])
            if len(out) >= _FRAME:
                yield pd.DataFrame(out, columns=_OUT.names)
                out.clear()
        self._store(stretches, later, known is not None, waited)
        if out:
            yield pd.DataFrame(out, columns=_OUT.names)

    def _released(self, session: str, stretch: _Stretch | None, rows: list[tuple], clock: int, out: list[tuple]) -> _Stretch | None:
        """What is known of a session after these rows, in their order; rows of windows that are whole go to ``out``."""
        for row in rows:
            if stretch and row[0] - stretch.last > self.idle:
                out += self._confirmed(session, stretch) + self._end(session, stretch)
                stretch = None
            if stretch is None:
                stretch = _Stretch(row[0], row[0], *row[-2:])
            stretch.held.append(self._clean(stretch, row))
            stretch.last = row[0]
        if stretch:
            out += self._confirmed(session, stretch)
            if clock >= stretch.last + self.idle:
                out += self._end(session, stretch)
                stretch = None
        return stretch

    def _store(self, stretches: dict[str, _Stretch], later: tuple[list, list], known: bool, waited: bool) -> None:
        if later[1]:
            self.pending.put([(pickle.dumps(later),)])
            self.handle.registerTimer(_millis(min(map(_time, later[1]))))
        elif waited:
            self.pending.clear()
        if stretches:
            self.known.update((pickle.dumps(stretches),))
            self.handle.registerTimer(_millis(min(s.last for s in stretches.values()) + self.idle))
        elif known:
            self.known.clear()

    def _clean(self, s: _Stretch, row: tuple) -> tuple:
        """The sample with its fills and, from before it, the last plausible interval and when it was seen."""
        us, _, _, *ibi, hr, temp, quality, _, _ = row
        s.hr, s.hr_age = (hr, 0) if hr is not None else (s.hr, s.hr_age + 1)
        s.temp, s.temp_age = (temp, 0) if temp is not None else (s.temp, s.temp_age + 1)
        s.quality = s.quality if quality is None else quality
        got = (us, *ibi, s.hr if s.hr_age <= self.hr_rows else None, s.temp if s.temp_age <= self.temp_rows else None, s.prev_value, s.prev_us, s.quality)
        if ibi[0] is not None and ibi[0] > 0:
            s.prev_value, s.prev_us = s.prev_value if ibi[-1] is None else ibi[-1], float(us)
        return got

    def _confirmed(self, session: str, s: _Stretch) -> list[tuple]:
        """Rows of all windows that end at or before the last sample; the rows that later windows need stay held."""
        until = (s.last - s.start - self.size) // self.stride
        if until < s.next_window:
            return []
        out, times, k = [], [row[0] for row in s.held], s.next_window
        while k <= until:
            begin = s.start + k * self.stride
            low, high = bisect_left(times, begin), bisect_left(times, begin + self.size)
            if low < high:
                # The sample that shows a window to be whole: the first one at or behind its end.
                out += self._rows(session, s, s.held[low:high], k, begin, begin + self.size, times[high])
                k += 1
            else:
                # On to the first window that ends behind the next sample.
                k = max(k + 1, (times[low] - s.start - self.size) // self.stride + 1)
        s.next_window = until + 1
        s.held = s.held[bisect_left(times, s.start + s.next_window * self.stride):]
        return out

    def _end(self, session: str, s: _Stretch) -> list[tuple]:
        """A session shorter than the window is one window of all its rows."""
        return [] if s.next_window else self._rows(session, s, s.held, 0, s.start, s.last, s.last + self.idle)

    @staticmethod
    def _rows(session, s, rows, index, begin, end, closed) -> list[tuple]:
        own = (pd.Timestamp(closed, unit="us", tz="UTC"), session, s.user_id, s.device_id, index, begin, end)
        return [own + row for row in rows]


def _place(row: tuple) -> tuple:
    """Order of samples; missing places first."""
    return row[0], row[1] is not None, row[1] or 0.0, row[2] is not None, row[2] or 0.0


def _time(row: tuple) -> int:
    return row[0]


def _millis(us: int) -> int:
    """The first whole millisecond at or behind a time; the watermark counts in these."""
    return -(-us // 1000)


@contextmanager
def ordered_state(spark: SparkSession) -> Iterator[None]:
    """The state store that ordered state needs, while a query is started; the session's own setting comes back afterwards."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def windowed_sessions_stream(samples: DataFrame, params: RunParams = RunParams(), idle_seconds: float = 600.0, groups: int = GROUPS) -> DataFrame:
    """Cleaned samples with their sliding windows, as the batch operators give them; each window appears whole, once.

    ``samples`` carries a watermark on ``timestamp``. A session ends when no sample follows for ``idle_seconds``: its id may come back and
    then begins anew, with windows and fills of its own. Samples without a session or time belong to no window and are left out.
    A task holds the open windows of one group of sessions at a time and what of it arrives in one trigger; bound the latter at the source, and the
    former by ``groups``, some hundred sessions in each, which stays the same for the life of a checkpoint.
    """
    ibi = ibi_summary_struct("ibi_ms")
    flat = samples.filter("session_id IS NOT NULL AND timestamp IS NOT NULL").withColumn("ibi", ibi).select(
        F.pmod(F.xxhash64("session_id"), F.lit(groups)).alias("group"), "session_id", "timestamp", F.unix_micros("timestamp").alias("us"),
        F.col("sequence").cast("double"), F.col("pos").cast("double"), "user_id", "device_id", "heart_rate_bpm", "skin_temperature_celsius", "quality_heart_rate",
        *[F.col(f"ibi.{n}").cast("double").alias(f"ibi_{n}") for n in _IBI])
    rows = flat.groupBy("group").transformWithStateInPandas(
        _Sessions(params, micros(idle_seconds)), _OUT, "append", "eventTime", eventTimeColumnName="closed_at")
    interval = F.struct(*[F.col(f"ibi_{n}").cast(kind).alias(n) for n, kind in _IBI.items()])
    before = F.struct(F.col("prev_value").alias("value"), F.timestamp_micros(F.col("prev_us").cast("long")).alias("at"))
    return rows.withColumns({
        "timestamp": F.timestamp_micros("us"), "window_start": F.timestamp_micros("start_us"), "window_end": F.timestamp_micros("end_us"),
        "ibi": F.when(F.col("ibi_n").isNotNull(), interval), "ibi_prev": F.when(F.col("prev_us").isNotNull(), before),
    }).drop("us", "start_us", "end_us", "prev_value", "prev_us", *[f"ibi_{n}" for n in _IBI])


def session_features_stream(samples: DataFrame, params: RunParams = RunParams(), idle_seconds: float = 600.0,
                            as_of: Column | None = None, groups: int = GROUPS) -> DataFrame:
    """Metadata, ``reason`` and features of each sliding window of a session, fills and HRV included.

    Equal to :func:`pulseframe.plans.windows.sliding_features` for sessions without a pause longer than ``idle_seconds``, except that the
    minimum of rows applies to the window alone. Start the query inside :func:`ordered_state`.
    """
    windowed = windowed_sessions_stream(samples, params, idle_seconds, groups)
    got = window_features(windowed, ["closed_at", *SLIDING_KEYS], params.features, as_of=as_of, extra=metadata_aggregates())
    return sliding_gate(name_owner(got), params.window)
