"""Telemetry-shaped projections of the driver's tables, used by the registered queries and the tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.params import CleanParams, EventWindowParams, WindowParams

# The event table spans 30 days with a few rows per user and day, so windows are counted in days.
WINDOW = WindowParams(size_seconds=604_800, stride_seconds=302_400, min_samples=10, min_hr_ratio=0.3)
EVENT_WINDOW = EventWindowParams(size_seconds=604_800, min_samples=10, min_hr_ratio=0.3)
CLEAN = CleanParams()

_FAR_SECONDS = 3650 * 86_400
TRIGGERS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0).cast("int")


def _user() -> Column:
    return F.floor(F.col("user_id") / 3).cast("bigint").cast("string")


def _device() -> Column:
    return (F.col("user_id") % 50).cast("string")


def _batch_id() -> Column:
    """One batch per session and week."""
    return F.concat_ws("-", F.col("user_id").cast("string"), F.weekofyear("ts").cast("string"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream of time ranges that arrive in order, one for each trigger, each with as many files as the table has splits."""
    events = table(spark, sf_dir, "events")
    low, high, last = events.select("ts", F.spark_partition_id().alias("split")).agg(F.min("ts"), F.max("ts"), F.max("split")).first()
    folder, step, files = scratch(spark), (high - low) / TRIGGERS, last + 1
    for i in range(TRIGGERS):
        inside = F.col("ts") >= F.lit(low + i * step)
        inside = inside & (F.col("ts") < F.lit(low + (i + 1) * step)) if i < TRIGGERS - 1 else inside
        # The source takes files in the order of their times, the same number for each trigger: empty files fill a range up.
        events.filter(inside).write.mode("append").parquet(folder)
        for _ in range((i + 1) * files - len(spark.read.schema(events.schema).parquet(folder).inputFiles())):
            events.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(folder)


def samples(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Flat samples; three sessions share a user. ``pos`` is the place in the batch by (ts, event_id).

    A stream cannot number rows of a batch that still arrives, so there the event id stands in as tie-break.
    """
    kind, k = F.col("event_type"), _k()
    quality = (F.when(kind.isin("click", "purchase"), "good").when(kind == "view", "fair")
               .when(kind == "error", "poor").otherwise("unknown"))
    beats = F.array((600 + k).cast("double"), (620 + 2 * k).cast("double"), (25 * k).cast("double"))
    events = table(spark, sf_dir, "events") if events is None else events
    session = F.col("user_id").cast("string")
    if events.isStreaming:
        pos = F.col("event_id")
    else:
        # Dealt by session once, so the operators that work per session need no exchange of their own.
        events = events.withColumns({"session_id": session, "week": F.weekofyear("ts")}).repartition("session_id")
        pos = (F.row_number().over(Window.partitionBy("session_id", "week").orderBy("ts", "event_id")) - 1).cast("bigint")
        session = F.col("session_id")
    return events.select(
        _batch_id().alias("batch_id"),
        _user().alias("user_id"), _device().alias("device_id"), session.alias("session_id"),
        F.weekofyear("ts").cast("bigint").alias("sequence"), pos.alias("pos"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(kind != "error", 40 + F.col("value")).alias("heart_rate_bpm"),
        F.when(kind.isin("view", "click"), beats).otherwise(F.array().cast("array<double>")).alias("ibi_ms"),
        F.when(kind != "signup", F.lit(30.0) + k / F.lit(20.0)).alias("skin_temperature_celsius"),
        quality.alias("quality_heart_rate"),
        F.when(kind.isin("view", "click"), "good").otherwise("unknown").alias("quality_ibi"),
        F.lit("unknown").alias("quality_wearing_state"),
    )


def gappy_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples whose quality columns are missing at times, as flat files may have them."""
    return samples(spark, sf_dir).withColumns({
        "quality_heart_rate": F.when(F.col("pos") % 3 != 0, F.col("quality_heart_rate")),
        "quality_ibi": F.when(F.col("pos") % 4 != 0, F.col("quality_ibi")),
    })


def _base_events(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if events is None else events
    far = F.when(F.col("event_id") % 105 == 0, F.lit(_FAR_SECONDS)).otherwise(F.lit(0)).cast("bigint")
    at = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + far * 1_000_000)
    return events.select(
        F.col("event_id").alias("n"), F.col("event_id").cast("string").alias("event_id"), _device().alias("device_id"), _user().alias("user_id"),
        F.col("user_id").cast("string").alias("session_id"), F.weekofyear("ts").cast("bigint").alias("sequence"), at.alias("at"), _k().alias("k"))


def _later(column: str, seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(column) + seconds * 1_000_000)


def _copies(df: DataFrame, *extra: tuple[Column, dict[str, Column]]) -> DataFrame:
    """The rows plus changed copies of the rows that meet a condition, in one pass over the input."""
    marks = F.array_compact(F.array(F.lit(0), *[F.when(cond, F.lit(i)) for i, (cond, _) in enumerate(extra, 1)]))
    out = df.withColumn("__copy", F.explode(marks))
    for i, (_, changes) in enumerate(extra, 1):
        for name, value in changes.items():
            out = out.withColumn(name, F.when(F.col("__copy") == i, value).otherwise(F.col(name)))
    return out.drop("__copy")


def suspected(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Detector events, some repeated exactly and some with a different score."""
    k, n = F.col("k"), F.col("n")
    rows = _base_events(spark, sf_dir, events)
    rows = rows.select(
        "n", "event_id", "device_id", "user_id", "session_id", "sequence",
        F.when(n % 91 == 0, _later("at", 1)).otherwise(F.col("at")).alias("detected_at"), "at",
        F.lit("SUSPECTED").alias("state"), (k / F.lit(100.0)).alias("score"), F.lit("r1").alias("rules_version"),
        F.struct(
            F.when(k % 5 != 0, (60 + k).cast("double")).alias("heart_rate_mean"),
            (90 + k).cast("double").alias("heart_rate_max"),
            F.lit(0.0).alias("heart_rate_slope_bpm_per_minute"),
            F.when(k % 4 != 0, (k - 10).cast("double")).alias("heart_rate_delta_from_baseline"),
            (k * 10).cast("double").alias("rmssd_millis"), (k * 8).cast("double").alias("sdnn_millis"),
            F.lit(None).cast("double").alias("movement_magnitude_mean"),
            F.lit(None).cast("double").alias("movement_variance"),
            F.lit(0.8).alias("valid_sample_ratio"), F.lit(0).cast("bigint").alias("last_sample_age_seconds"),
            (k % 20).cast("bigint").alias("sample_count")).alias("features"),
        F.struct(F.lit(30).cast("bigint").alias("sample_count"), F.lit(70.0).alias("mean_heart_rate"),
                 F.lit(0.0).alias("heart_rate_m2"), F.lit(0).cast("bigint").alias("updated_at_epoch_millis")).alias("baseline"))
    rows = _copies(rows, (n % 35 == 0, {}), (n % 77 == 0, {"score": F.col("score") + 0.5, "detected_at": F.col("at")}))
    return rows.drop("n", "at")


def decisions(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """User responses to detector events, some missing, repeated or contradictory."""
    k, n = F.col("k"), F.col("n")
    response = (F.when(k % 4 == 0, "SUPPORT_REQUESTED").when(k % 4 == 1, "ACTIVITY_CONFIRMED")
                .when(k % 4 == 2, " user_ok ").otherwise("BREATHING_HELPED"))
    rows = _base_events(spark, sf_dir, events).filter(n % 49 != 0).select(
        "n", "event_id", "device_id", "user_id", "session_id", "sequence", F.col("at").alias("detected_at"),
        _later("at", 60).alias("responded_at"), response.alias("response"))
    return _copies(rows, (n % 35 == 0, {}), (n % 119 == 0, {"response": F.lit("USER_OK_2")})).drop("n")


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested batch documents rebuilt from the flat samples."""
    from pulseframe.operators.flatten import unflatten

    return unflatten(samples(spark, sf_dir))


def faulty_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with faults by session and week: empty, over 600 samples, ended before started, negative sequence."""
    kind = (F.col("session_id").cast("bigint") + 7 * F.col("sequence")) % 11
    longer = F.flatten(F.array_repeat("samples", F.ceil(F.lit(601) / F.size("samples")).cast("int")))
    samples = F.when(kind == 0, F.slice("samples", 1, 0)).when(kind == 1, longer).otherwise(F.col("samples"))
    return batches(spark, sf_dir).withColumns({
        "ended_at": F.when(kind == 2, _later("started_at", -1)).otherwise(F.col("ended_at")), "samples": samples,
        "sequence": F.when(kind == 3, -F.col("sequence")).otherwise(F.col("sequence"))})


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with a stated score, for the metric queries: ties occur and both classes exist."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id", "lang", "source", F.col("quality").alias("label"),
        (F.col("n_chars") % 997 / F.lit(997.0)).alias("score"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests: one per batch with its samples, anchored four days after its first sample."""
    from pulseframe.operators.flatten import unflatten

    docs = unflatten(samples(spark, sf_dir))
    return docs.select(F.col("batch_id").alias("event_id"), "device_id", "user_id", "session_id",
                       _later("started_at", 4 * 86_400).alias("detected_at"), "samples")


def scratch(spark: SparkSession) -> str:
    """A new folder name next to the checkpoints, on storage every executor reaches."""
    import uuid

    from pulseframe.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/run-{uuid.uuid4().hex}"
