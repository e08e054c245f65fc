"""Features of event windows without a row for every event and sample.

Time is cut into panes as long as the window. A window that ends at T in pane b starts at the same place of pane b - 1, so it is the rest
of pane b - 1 from its start and the part of pane b up to T. Events are laid among the samples of both panes; running
aggregates forward give the part of pane b at the event's row, running aggregates backward the rest of pane b - 1, and everything of the window
follows from the two. Work grows with samples plus events, however much windows overlap; a pane, not a session, is what one task sorts.
Each direction is a pass of its own over the columns it reads, dealt over as many tasks as its rows need, so what a task sorts does not grow with the table.

A window is cleaned alone, so a fill may only use a source inside it. Fills are made once per chain of samples and remember
when their source was seen. In pane b - 1 the rows before the first own value from the window's start on are unfilled: the backward
aggregates are read at that value. In pane b the rows filled from an earlier pane (its head) count only when pane b - 1 gave a value.
The same holds for the difference between the first interval of pane b and the last one before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pulseframe.functions.columns import NN_STEP_MS, finite_or_null, micros
from pulseframe.functions.scale import HotKeys, join_same, ordered
from pulseframe.operators.clean import with_ibi
from pulseframe.params import RunParams, ScaleParams
from pulseframe.schemas import SAMPLE_ORDER
from pulseframe.session import cut_lineage

CHAIN = ["session_id", "device_id", "__user"]
# Samples and events that one task is to hold, whatever the settings of the session say.
ROWS_PER_TASK = 100_000
# Sums are taken around these points; any value gives the same result, these keep digits.
_HR_CENTRE, _TEMP_CENTRE = 75.0, 33.0


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows spread by their keys over tasks of about ROWS_PER_TASK."""
    return df.repartition(max(1, -(-rows // ROWS_PER_TASK)), *keys)


def chained(samples: DataFrame, events: DataFrame, size: int) -> DataFrame:
    """Samples of the panes that events reach, once per chain: the event's user, or any user where an event has none."""
    at = F.unix_micros("timestamp")
    s = with_ibi(samples).select(
        "session_id", "device_id", F.col("user_id").alias("__user"), *SAMPLE_ORDER, at.alias("__t"), F.floor(at / F.lit(size)).alias("__pane"),
        "heart_rate_bpm", "skin_temperature_celsius", "quality_heart_rate", "ibi")
    if not events.filter(F.col("__user").isNull()).isEmpty():
        s = s.withColumn("__user", F.explode(F.array_distinct(F.array("__user", F.lit(None).cast("string")))))
    reached = events.select(*CHAIN, F.explode(F.array(F.col("__pane"), F.col("__pane") - 1)).alias("__pane")).distinct()
    return join_same(s, reached, [*CHAIN, "__pane"], "left_semi")


def filled(s: DataFrame, params: RunParams, scale: ScaleParams, hot: HotKeys | str | None = "detect") -> DataFrame:
    """Fills with the time of their source, and the last plausible interval before each sample with its time."""
    def seen(column: str, *more: Column) -> Column:
        return F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("v"), F.col("__t").alias("at"), *more))

    def bounded(d: DataFrame, w: WindowSpec) -> DataFrame:
        # The last value so far with its row number, dropped where that is too far back: a sliding frame would read all its rows again at every row.
        fills = {"__hr": ("heart_rate_bpm", params.clean.hr_fill_rows), "__temp": ("skin_temperature_celsius", params.clean.temp_fill_rows)}
        d = d.withColumn("__nth", F.row_number().over(w))
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumns({name: F.last(seen(column, F.col("__nth").alias("nth")), ignorenulls=True).over(upto) for name, (column, _) in fills.items()})
        return d.withColumns({name: F.when(F.col("__nth") - F.col(f"{name}.nth") <= rows, F.col(name)) for name, (_, rows) in fills.items()}).drop("__nth")

    last_interval = F.when(F.col("ibi.n") > 0, F.struct(F.col("ibi.last").alias("v"), F.col("__t").alias("at")))
    carried = {"__q": (seen("quality_heart_rate"), True), "__prev": (last_interval, False)}
    return ordered(s, CHAIN, SAMPLE_ORDER, bounded, max(params.clean.hr_fill_rows, params.clean.temp_fill_rows), 0, carried, scale, hot)


def _moments(value: str, x: str | None = None) -> dict[str, str]:
    """Aggregates of a value that is null where it does not count, and of its line over x minutes."""
    out = {"n": f"count({value})", "y": f"sum({value})", "yy": f"sum({value} * {value})", "low": f"min({value})", "high": f"max({value})"}
    if x:
        v = f"IF({value} IS NOT NULL, {x}, NULL)"
        out |= {"x": f"sum({v})", "xx": f"sum({v} * {v})", "xy": f"sum({v} * {value})", "first": f"min({v})", "last": f"max({v})"}
    return out


def _running(d: DataFrame, groups: dict[str, dict[str, str]], w: WindowSpec) -> DataFrame:
    """One struct column per group, with the running aggregates up to each row."""
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    flat = {f"__{g}__{k}": F.expr(v).over(frame) for g, parts in groups.items() for k, v in parts.items()}
    d = d.withColumns(flat)
    return d.withColumns({g: F.struct(*[F.col(f"__{g}__{k}").alias(k) for k in parts]) for g, parts in groups.items()}).drop(*flat)


def _parts(s: DataFrame, events: DataFrame, size: int, n_samples: int, n_events: int) -> DataFrame:
    """Per event: ``p``, the aggregates of its pane up to T, and ``r``, those of the rest of the pane before."""
    pane = F.col("__pane") * size
    minutes = (F.col("__t") - pane) / F.lit(6e7)
    jump = F.when(F.col("ibi.n") > 0, F.col("ibi.first") - F.col("__prev.v"))
    own = {c: F.coalesce(F.col(f"{c}.at") >= pane, F.lit(False)) for c in ("__hr", "__temp", "__q", "__prev")}
    hr, temp = F.col("__hr.v") - _HR_CENTRE, F.col("__temp.v") - _TEMP_CENTRE
    poor = F.col("__hr").isNotNull() & (F.col("__q.v") == "poor")
    s = s.withColumns({
        "__row": F.lit(1), "__x": minutes, "__back": minutes - size / 6e7, "hr": hr, "temp": temp, "poor": poor, "jump": jump,
        "hr_own": F.when(own["__hr"], hr), "hr_head": F.when(~own["__hr"], hr), "temp_own": F.when(own["__temp"], temp), "temp_head": F.when(~own["__temp"], temp),
        "q_own": F.when(own["__q"], F.col("__q.v")), "q_head": F.when(~own["__q"], F.col("__q.v")),
        "jump_own": F.when(own["__prev"], jump), "jump_head": F.when(~own["__prev"], jump),
        **{f"poor_{a}_{b}": poor & (own["__hr"] if a == "own" else ~own["__hr"]) & (own["__q"] if b == "own" else ~own["__q"])
           for a in ("own", "head") for b in ("own", "head")}})

    def quality(column: str) -> dict[str, str]:
        return {k: f"count_if({column} = '{k}')" for k in ("good", "fair", "poor")}

    def jumps(column: str) -> dict[str, str]:
        return {"ss": f"sum({column} * {column})", "over": f"count_if(abs({column}) > {NN_STEP_MS}D)"}

    always = {"rows": "count(__row)", "raw": "count(heart_rate_bpm)", "ibi": "count(ibi)", "n": "sum(ibi.n)", "d1": "sum(ibi.d1)", "d2": "sum(ibi.d2)",
              "ss": "sum(ibi.ss)", "over": "sum(ibi.over)", "first": "min(IF(__row = 1, __t, NULL))", "last": "max(IF(__row = 1, __t, NULL))"}
    forward = {"all": always, "hr_o": _moments("hr_own", "__x"), "hr_h": _moments("hr_head", "__x"), "temp_o": _moments("temp_own"), "temp_h": _moments("temp_head"),
               "q_o": quality("q_own"), "q_h": quality("q_head"), "j_o": jumps("jump_own"), "j_h": jumps("jump_head"),
               "bad": {f"{a}_{b}": f"count_if(poor_{a}_{b})" for a in ("own", "head") for b in ("own", "head")}}
    backward = {"all": always, "hr_r": _moments("hr", "__back"), "temp_r": _moments("temp"), "q_r": quality("`__q`.v"), "j_r": jumps("jump"), "bad_r": {"n": "count_if(poor)"}}

    later = SAMPLE_ORDER[1:]
    by = Window.partitionBy(*CHAIN, "__pane")

    def laid(columns: str, t: Column, pane: Column) -> DataFrame:
        """One mark per event among the samples of its pane, with the columns that one direction reads.

        ``__mark`` is a column, not an expression of the order: so windows of one order share a sort.
        """
        marks = events.select("event_id", *CHAIN, t.alias("__t"), pane.alias("__pane"), F.lit(True).alias("__mark"))
        rows = s.select(*CHAIN, "__pane", "__t", *later, "__row", F.lit(False).alias("__mark"), "heart_rate_bpm", "ibi", *columns.split())
        return dealt(rows.unionByName(marks, allowMissingColumns=True), n_samples + n_events, *CHAIN, "__pane")

    def marked(d: DataFrame, name: str, parts: list[str], t: Column) -> DataFrame:
        return d.filter(F.col("event_id").isNotNull()).select("event_id", *CHAIN, t.alias("__t"), F.struct(*parts).alias(name))

    ends = laid("__x hr_own hr_head temp_own temp_head q_own q_head jump_own jump_head poor_own_own poor_own_head poor_head_own poor_head_head",
                F.col("__t"), F.col("__pane"))
    ends = _running(ends, forward, by.orderBy("__t", "__mark", *later))
    starts = laid("skin_temperature_celsius quality_heart_rate hr __back temp __q jump poor", F.col("__t") - size, F.col("__pane") - 1)
    w = by.orderBy(F.desc("__t"), "__mark", *[F.desc(c) for c in later])
    starts = _running(starts, backward, w)
    # What a fill or a difference may use from the start of the window on: the aggregates as they were at the first own value.
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    at = {"hr_r": F.col("heart_rate_bpm").isNotNull(), "temp_r": F.col("skin_temperature_celsius").isNotNull(), "q_r": F.col("quality_heart_rate").isNotNull()}
    before = {k: F.col(f"j_r.{k}") - F.coalesce(v, F.lit(0)) for k, v in {"ss": F.col("jump") * F.col("jump"), "over": (F.abs("jump") > NN_STEP_MS).cast("long")}.items()}
    starts = starts.withColumns({
        **{name: F.last(F.when(own_value, F.col(name)), ignorenulls=True).over(frame) for name, own_value in at.items()},
        "bad_h": F.last(F.when(at["hr_r"], F.col("bad_r.n")), ignorenulls=True).over(frame), "bad_q": F.last(F.when(at["q_r"], F.col("bad_r.n")), ignorenulls=True).over(frame),
        "j_r": F.last(F.when(F.col("ibi.n") > 0, F.struct(*[v.alias(k) for k, v in before.items()])), ignorenulls=True).over(frame)})
    ends = marked(ends, "p", [*forward], F.col("__t"))
    starts = marked(starts, "r", ["all", "hr_r", "temp_r", "q_r", "j_r", "bad_h", "bad_q"], F.col("__t") + size)
    both = dealt(ends.unionByName(starts, allowMissingColumns=True), 2 * n_events, "event_id")
    return both.groupBy("event_id", *CHAIN, "__t").agg(F.first("p", ignorenulls=True).alias("p"), F.first("r", ignorenulls=True).alias("r"))


def event_pane_features(samples: DataFrame, events: DataFrame, params: RunParams = RunParams(), scale: ScaleParams = ScaleParams(),
                        as_of: Column | None = None) -> DataFrame:
    """Per event with at least one sample: event_id, n_samples, hr_ratio (both of raw samples), then the chosen features.

    ``events`` needs event_id (one row each), session_id, device_id, user_id and detected_at. Equal to joining, cleaning and aggregating every window.
    """
    size = micros(params.event_window.size_seconds)
    e = events.filter("session_id IS NOT NULL AND device_id IS NOT NULL AND detected_at IS NOT NULL").select(
        "event_id", "session_id", "device_id", F.col("user_id").alias("__user"), F.unix_micros("detected_at").alias("__t"))
    e = e.withColumn("__pane", F.floor(F.col("__t") / F.lit(size)))
    reached = cut_lineage(chained(samples, e, size))
    parts = _parts(filled(reached, params, scale), e, size, reached.count(), e.count())
    return finite_or_null(_assembled(parts, params, as_of))


def _assembled(parts: DataFrame, params: RunParams, as_of: Column | None) -> DataFrame:
    """The features, in steps: sums over both parts of a window become columns before features are made of them.

    In one step every feature repeats the sums it uses, and all of it becomes one method.
    """
    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def both(name: str) -> Column:
        return zero(f"p.all.{name}") + zero(f"r.all.{name}")

    def total(group: str, name: str) -> Column:
        """Rest of the pane before, own rows of the pane, and its head where that rest gave a value."""
        head = F.when(F.col(f"r.{group}_r").isNotNull(), zero(f"p.{group}_h.{name}")).otherwise(F.lit(0))
        return zero(f"r.{group}_r.{name}") + zero(f"p.{group}_o.{name}") + head

    def extreme(pick, group: str, name: str) -> Column:
        return pick(F.col(f"r.{group}_r.{name}"), F.col(f"p.{group}_o.{name}"), F.when(F.col(f"r.{group}_r").isNotNull(), F.col(f"p.{group}_h.{name}")))

    def ends(group: str, low: str, high: str) -> dict[str, Column]:
        return {f"{group}_{low}": extreme(F.least, group, low), f"{group}_{high}": extreme(F.greatest, group, high)}

    poor = F.least(zero("r.bad_h"), zero("r.bad_q")) + zero("p.bad.own_own")
    poor += F.when(F.col("r.hr_r").isNotNull(), zero("p.bad.head_own")).otherwise(F.lit(0))
    poor += F.when(F.col("r.q_r").isNotNull(), zero("p.bad.own_head")).otherwise(F.lit(0))
    poor += F.when(F.col("r.hr_r").isNotNull() & F.col("r.q_r").isNotNull(), zero("p.bad.head_head")).otherwise(F.lit(0))
    steps = [
        {"n": both("rows"), "raw": both("raw"), "ibi": both("ibi"), "k": both("n"), "d1": both("d1"), "d2": both("d2"), "poor": poor,
         "first": F.least("r.all.first", "p.all.first"), "last": F.greatest("r.all.last", "p.all.last"),
         # Differences inside samples and between neighbouring ones, both of them in the window.
         **{name: both(name) + total("j", name) for name in ("ss", "over")}},
        {**{f"hr_{name}": total("hr", name) for name in ("n", "y", "yy", "x", "xx", "xy")}, **ends("hr", "low", "high"), **ends("hr", "first", "last")},
        {**{f"temp_{name}": total("temp", name) for name in ("n", "y", "yy")}, **ends("temp", "low", "high"),
         **{f"q_{name}": total("q", name) for name in ("good", "fair", "poor")}},
    ]
    found, names = parts.select("event_id", "p", "r"), []
    for i, step in enumerate(steps):
        sides = ["p", "r"] if i < len(steps) - 1 else []
        found = found.select("event_id", *names, *[value.alias(f"__{name}") for name, value in step.items()], *sides)
        names += [f"__{name}" for name in step]

    def of(name: str) -> Column:
        return F.col(f"__{name}")

    n, hr_n, temp_n, k = of("n"), of("hr_n"), of("temp_n"), of("k")

    def std(group: str, count: Column) -> Column:
        spread = F.greatest(of(f"{group}_yy") - of(f"{group}_y") * of(f"{group}_y") / count, F.lit(0.0))
        flat = of(f"{group}_low") == of(f"{group}_high")
        return F.when(count == 0, None).when((count == 1) | flat, 0.0).otherwise(F.sqrt(spread / (count - 1)))

    def mean(group: str, count: Column, centre: float) -> Column:
        return F.when(count > 0, of(f"{group}_y") / count + centre)

    def hrv(value: Column) -> Column:
        return F.when(k >= 3, value)

    line = hr_n * of("hr_xx") - of("hr_x") * of("hr_x")
    slope = (hr_n * of("hr_xy") - of("hr_x") * of("hr_y")) / line
    instant = of("hr_first") == of("hr_last")
    now = as_of if as_of is not None else F.current_timestamp()
    rules = {
        "hr_mean": mean("hr", hr_n, _HR_CENTRE), "hr_std": std("hr", hr_n),
        "hr_min": of("hr_low") + _HR_CENTRE, "hr_max": of("hr_high") + _HR_CENTRE,
        "hr_slope_bpm_per_min": F.when(hr_n == 1, 0.0).when((hr_n > 1) & ~instant, slope),
        "hrv_rmssd": hrv(F.sqrt(of("ss") / (k - 1))),
        "hrv_sdnn": hrv(F.sqrt(F.greatest(of("d2") - of("d1") * of("d1") / k, F.lit(0.0)) / (k - 1))),
        "hrv_pnn50": hrv(of("over") * 100.0 / (k - 1)),
        "ibi_available": F.when(of("ibi") > 0, 1.0).otherwise(0.0), "ibi_coverage_ratio": of("ibi") / n,
        "movement_magnitude_mean": F.lit(None).cast("double"), "movement_variance_mean": F.lit(None).cast("double"),
        "skin_temp_mean": mean("temp", temp_n, _TEMP_CENTRE), "skin_temp_std": std("temp", temp_n),
        "quality_good_ratio": of("q_good") / n, "quality_fair_ratio": of("q_fair") / n, "quality_poor_ratio": of("q_poor") / n,
        "valid_sample_ratio": (hr_n - of("poor")) / n, "window_duration_seconds": (of("last") - of("first")) / F.lit(1e6), "sample_count": n.cast("double"),
        "last_sample_age_seconds": (F.unix_micros(now) - of("last")) / F.lit(1e6),
    }
    return found.filter(n > 0).select("event_id", n.cast("long").alias("n_samples"), (of("raw") / n).alias("hr_ratio"),
                                      *[rules[name].cast("double").alias(name) for name in params.features.names()])
