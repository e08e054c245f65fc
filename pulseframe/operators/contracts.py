"""Contract normalisation: any key spelling to the declared fields, checks, and quarantine with a reason.

Everything is column expressions over one row per document, so the job is one scan without a shuffle.
Keys are matched by their lower-case letters and digits only; when one document spells a field several times
the last value wins, except for the user id, where differing values are a conflict.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.schemas import (
    BASELINE, DECISION, MAX_IBI, MAX_SAMPLES, REQUEST, SAMPLE, SIGNAL_QUALITY, SNAPSHOT, SUSPECTED,
    TELEMETRY, WEARING_STATE,
)

SCHEMAS = {"telemetry": TELEMETRY, "suspected": SUSPECTED, "decision": DECISION, "request": REQUEST}

# Reasons of rejected documents.
IDENTITY_MISMATCH = "identity_mismatch"
INVALID_DOCUMENT = "invalid_document"

_HYPHENATED = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
_PLAIN_HEX = r"^[0-9a-f]{32}$"


def canonical(key: Column) -> Column:
    """EventId, eventId and event_id all become eventid."""
    return F.lower(F.regexp_replace(key, r"[^\p{L}\p{N}]", ""))


def _canon_name(name: str) -> str:
    return name.replace("_", "").lower()


def entries(text: Column) -> Column:
    """Pairs of a JSON object in document order: canonical key, value (nested ones as JSON text), key as written."""
    pairs = F.map_entries(F.from_json(text, T.MapType(T.StringType(), T.StringType())))
    return F.transform(pairs, lambda e: F.struct(
        canonical(e["key"]).alias("k"), e["value"].alias("v"), e["key"].alias("name")))


def field_text(pairs: Column, name: str) -> Column:
    """Text of the last spelling of a field; null when absent or JSON null."""
    hits = F.filter(pairs, lambda e: e["k"] == _canon_name(name))
    return F.try_element_at(hits, F.lit(-1))["v"]


def has_field(pairs: Column, name: str) -> Column:
    return F.exists(pairs, lambda e: e["k"] == _canon_name(name))


def user_ids(pairs: Column) -> Column:
    """Distinct non-null user ids over all spellings."""
    mine = F.filter(pairs, lambda e: (e["k"] == "userid") & e["v"].isNotNull())
    return F.array_distinct(F.transform(mine, lambda e: e["v"]))


def document_id(pairs: Column) -> Column:
    """Best-effort id for the quarantine row: the first key that reads eventid or batchid."""
    mine = F.filter(pairs, lambda e: F.lower(F.replace(e["name"], F.lit("_"), F.lit(""))).isin("eventid", "batchid"))
    return F.try_element_at(mine, F.lit(1))["v"]


# --- typed reading of text -------------------------------------------------------------------------------

def as_uuid(text: Column) -> Column:
    """Lower-case hyphenated form, or null when the text is not a UUID."""
    bare = F.regexp_replace(F.lower(text), r"^urn:uuid:|^\{|\}$", "")
    grouped = F.regexp_replace(bare, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(bare.rlike(_HYPHENATED), bare).when(bare.rlike(_PLAIN_HEX), grouped)


def as_double(text: Column) -> Column:
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def as_long(text: Column) -> Column:
    """Whole numbers; "3.0" counts as 3, "3.5" does not count."""
    number = text.try_cast("double")
    whole = F.when((number == F.floor(number)) & (F.abs(number) < F.lit(9.0e15)), number.cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), whole)


def as_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def one_of(text: Column, domain: tuple[str, ...]) -> Column:
    return F.when(text.isin(*domain), text)


@dataclass(frozen=True)
class Field:
    """How one field is read: ``required`` forbids absence, ``default`` replaces absence (not null)."""

    name: str
    read: Callable[[Column], Column]
    required: bool = False
    default: object = None
    check: Callable[[Column], Column] | None = None

    def raw(self, pairs: Column) -> Column:
        """Text of the field and whether its key occurs at all."""
        return F.struct(field_text(pairs, self.name).alias("text"), has_field(pairs, self.name).alias("has")).alias(self.name)

    def value(self, raw: Column) -> Column:
        got = self.read(raw["text"])
        if self.default is not None:
            got = F.when(raw["has"], got).otherwise(F.lit(self.default))
        return got.alias(self.name)

    def problem(self, raw: Column, value: Column, prefix: str = "") -> Column:
        """The field name when its text is missing, unreadable or out of bounds; else null."""
        if self.required:
            bad = value.isNull()
        elif self.default is not None:
            bad = raw["has"] & value.isNull()
        else:
            bad = raw["text"].isNotNull() & value.isNull() & (F.lower(raw["text"]) != "nan")
        if self.check is not None:
            bad = bad | (value.isNotNull() & ~self.check(value))
        return F.when(bad, F.lit(prefix + self.name))


def raw_struct(fields: list[Field], pairs: Column) -> Column:
    return F.struct(*[f.raw(pairs) for f in fields])


def value_struct(fields: list[Field], raw: Column) -> Column:
    return F.struct(*[f.value(raw[f.name]) for f in fields])


def problem_list(fields: list[Field], raw: Column, values: Column, prefix: str = "") -> Column:
    return F.array_compact(F.array(*[f.problem(raw[f.name], values[f.name], prefix) for f in fields]))


def _text(col: Column) -> Column:
    return col


def _share(v: Column) -> Column:
    return (v >= 0.0) & (v <= 1.0)


def _count(v: Column) -> Column:
    return v >= 0


_IDS = [Field("device_id", as_uuid, True), Field("session_id", as_uuid, True)]

SNAPSHOT_FIELDS = [Field(f.name, as_double) for f in SNAPSHOT.fields[:8]] + [
    Field("valid_sample_ratio", as_double, default=0.0, check=_share),
    Field("last_sample_age_seconds", as_long, default=0),
    Field("sample_count", as_long, default=0),
]
BASELINE_FIELDS = [
    Field("sample_count", as_long, default=0), Field("mean_heart_rate", as_double, default=0.0),
    Field("heart_rate_m2", as_double, default=0.0), Field("updated_at_epoch_millis", as_long, default=0),
]
QUALITY_FIELDS = [
    Field("heart_rate", lambda t: one_of(t, SIGNAL_QUALITY), True),
    Field("ibi", lambda t: one_of(t, SIGNAL_QUALITY), True),
    Field("wearing_state", lambda t: one_of(t, WEARING_STATE), default="unknown"),
]
SAMPLE_FIELDS = [
    Field("timestamp", as_timestamp, True), Field("heart_rate_bpm", as_double),
    Field("skin_temperature_celsius", as_double), Field("ambient_temperature_celsius", as_double),
]
TOP_FIELDS = {
    "telemetry": [Field("batch_id", as_uuid, True), *_IDS, Field("started_at", as_timestamp, True),
                  Field("ended_at", as_timestamp, True), Field("sequence", as_long, True, check=_count)],
    "suspected": [Field("event_id", as_uuid, True), *_IDS, Field("sequence", as_long, default=0, check=_count),
                  Field("detected_at", as_timestamp, True), Field("state", _text, True),
                  Field("score", as_double, default=0.0, check=_share), Field("rules_version", _text, True)],
    "decision": [Field("event_id", as_uuid, True), *_IDS, Field("sequence", as_long, default=0, check=_count),
                 Field("detected_at", as_timestamp, True), Field("responded_at", as_timestamp, True),
                 Field("response", _text, True)],
    "request": [Field("event_id", as_uuid, True), *_IDS, Field("detected_at", as_timestamp, True)],
}


def sanitize_hr(hr: Column) -> Column:
    """A heart rate of zero or less means no reading."""
    return F.when(hr > 0, hr)


def truncate_ibi(ibi: Column, n: int = MAX_IBI) -> Column:
    """Keep the first ``n`` inter-beat intervals."""
    return F.slice(ibi, 1, n)


def _plain_entries(text: Column) -> Column:
    """Like :func:`entries`, but an empty array when the text is no JSON object."""
    return F.coalesce(entries(text), F.array().cast("array<struct<k:string,v:string,name:string>>"))


def _unknown_keys(pairs: Column, schema: T.StructType) -> Column:
    known = F.array(*[F.lit(_canon_name(f.name)) for f in schema.fields])
    return F.array_except(F.transform(pairs, lambda e: e["k"]), known)


def _no_names() -> Column:
    return F.array().cast("array<string>")


def _sample_raw(s: Column) -> Column:
    """Field texts of one sample, from its canonical entries and those of its quality object."""
    pairs, quality = s["pairs"], s["quality"]
    ibi = field_text(pairs, "ibi_ms")
    return F.struct(
        raw_struct(SAMPLE_FIELDS, pairs).alias("fields"), raw_struct(QUALITY_FIELDS, quality).alias("quality"),
        field_text(pairs, "quality").isNotNull().alias("has_quality"), ibi.isNotNull().alias("has_ibi"),
        F.from_json(ibi, T.ArrayType(T.StringType())).alias("ibi"),
        F.from_json(field_text(pairs, "accelerometer"), "struct<x:double,y:double,z:double>").alias("accelerometer"),
        s["unknown"].alias("unknown"))


def _sample_values(r: Column) -> Column:
    ibi = F.transform(truncate_ibi(F.coalesce(r["ibi"], _no_names())), lambda x: x.try_cast("double"))
    return F.struct(r.alias("raw"), value_struct(SAMPLE_FIELDS, r["fields"]).alias("values"),
                    value_struct(QUALITY_FIELDS, r["quality"]).alias("quality"), ibi.alias("ibi"))


def _sample_checked(s: Column) -> Column:
    raw, v = s["raw"], s["values"]
    bad_ibi = F.exists(s["ibi"], lambda x: x.isNull()) | (raw["has_ibi"] & raw["ibi"].isNull())
    problems = F.concat(
        problem_list(SAMPLE_FIELDS, raw["fields"], v, "samples."),
        F.array_compact(F.array(F.when(bad_ibi, F.lit("samples.ibi_ms")), F.when(~raw["has_quality"], F.lit("samples.quality")))),
        F.when(raw["has_quality"], problem_list(QUALITY_FIELDS, raw["quality"], s["quality"], "samples.quality.")).otherwise(_no_names()),
        F.transform(raw["unknown"], lambda k: F.concat(F.lit("samples.unknown:"), k)))
    sample = F.struct(
        v["timestamp"].alias("timestamp"), sanitize_hr(v["heart_rate_bpm"]).alias("heart_rate_bpm"), s["ibi"].alias("ibi_ms"),
        raw["accelerometer"].alias("accelerometer"), v["skin_temperature_celsius"].alias("skin_temperature_celsius"),
        v["ambient_temperature_celsius"].alias("ambient_temperature_celsius"), s["quality"].alias("quality"))
    return F.struct(sample.alias("sample"), problems.alias("problems"))


def parse_documents(raw: DataFrame, kind: str, unknown: str = "drop", value: str = "value") -> DataFrame:
    """Every document as declared columns plus ``doc_id``, ``kind``, ``reason`` and ``detail``.

    ``reason`` is null for a valid document, else identity_mismatch or invalid_document; ``detail`` lists the
    offending fields. ``unknown`` is "drop" to ignore undeclared keys or "reject" to refuse them.

    Written in stages (entries, texts, values, problems) so that each is computed once per document.
    """
    if unknown not in ("drop", "reject"):
        raise ValueError("unknown must be 'drop' or 'reject'")
    schema, fields = SCHEMAS[kind], TOP_FIELDS[kind]
    reject = unknown == "reject"
    objects = {n: parts for n, parts in (("features", SNAPSHOT_FIELDS), ("baseline", BASELINE_FIELDS)) if n in schema.fieldNames()}
    has_samples = "samples" in schema.fieldNames()

    d = raw.select(F.col(value).alias("__text")).withColumn("__pairs", _plain_entries(F.col("__text")))
    pairs = F.col("__pairs")
    stage: dict[str, Column] = {
        "__raw": raw_struct(fields, pairs), "__users": user_ids(pairs), "__doc_id": document_id(pairs),
        "__unknown": _unknown_keys(pairs, schema) if reject else _no_names()}
    for name in objects:
        stage[f"__text_{name}"] = field_text(pairs, name)
    if has_samples:
        stage["__items"] = F.coalesce(F.from_json(field_text(pairs, "samples"), T.ArrayType(T.StringType())), _no_names())
    d = d.withColumns(stage)

    stage = {"__v": value_struct(fields, F.col("__raw")), "__user": as_uuid(F.try_element_at("__users", F.lit(1)))}
    for name, parts in objects.items():
        stage[f"__raw_{name}"] = raw_struct(parts, _plain_entries(F.col(f"__text_{name}")))
    if has_samples:
        with_pairs = F.transform("__items", _plain_entries)
        with_quality = F.transform(with_pairs, lambda p: F.struct(
            p.alias("pairs"), _plain_entries(field_text(p, "quality")).alias("quality"),
            (_unknown_keys(p, SAMPLE) if reject else _no_names()).alias("unknown")))
        stage["__samples"] = F.transform(F.transform(F.transform(with_quality, _sample_raw), _sample_values), _sample_checked)
    d = d.withColumns(stage)
    d = d.withColumns({f"__v_{name}": value_struct(parts, F.col(f"__raw_{name}")) for name, parts in objects.items()}) if objects else d

    v, users = F.col("__v"), F.col("__users")
    problems = [problem_list(fields, F.col("__raw"), v), F.transform("__unknown", lambda k: F.concat(F.lit("unknown:"), k))]
    extra = [F.when((F.size(users) > 0) & F.col("__user").isNull(), F.lit("user_id"))]
    if has_samples:
        size = F.size("__samples")
        extra.append(F.when(size < 1, F.lit("samples.min")))
        if kind == "telemetry":
            extra.append(F.when(size > MAX_SAMPLES, F.lit("samples.max")))
        problems.append(F.flatten(F.transform("__samples", lambda s: s["problems"])))
    if kind == "telemetry":
        extra.append(F.when(v["ended_at"] < v["started_at"], F.lit("ended_at")))
    if kind == "decision":
        extra.append(F.when(v["responded_at"] < v["detected_at"], F.lit("responded_at")))
    for name, parts in objects.items():
        extra.append(F.when(F.col(f"__text_{name}").isNull(), F.lit(name)))
        problems.append(problem_list(parts, F.col(f"__raw_{name}"), F.col(f"__v_{name}"), f"{name}."))
    d = d.withColumn("__problems", F.array_distinct(F.concat(*problems, F.array_compact(F.array(*extra)))))

    columns = []
    for f in schema.fields:
        if f.name == "user_id":
            columns.append(F.col("__user").alias("user_id"))
        elif f.name == "samples":
            columns.append(F.transform("__samples", lambda s: s["sample"]).alias("samples"))
        elif f.name in objects:
            columns.append(F.col(f"__v_{f.name}").alias(f.name))
        else:
            columns.append(v[f.name].alias(f.name))
    reason = (F.when(F.size(users) > 1, F.lit(IDENTITY_MISMATCH)).when(F.size("__problems") > 0, F.lit(INVALID_DOCUMENT)))
    record = F.struct(*columns, F.col("__doc_id").alias("doc_id"), F.lit(kind).alias("kind"),
                      reason.alias("reason"), F.array_join(F.sort_array("__problems"), ",").alias("detail"))
    # A filter on the result must not be pushed below the parsing, which would run all of it twice per document;
    # it cannot pass a generated column.
    return d.select(F.explode(F.array(record)).alias("d")).select("d.*")


def split_documents(parsed: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(valid documents, quarantine rows)."""
    valid = parsed.filter(F.col("reason").isNull()).select(*SCHEMAS[kind].fieldNames())
    return valid, parsed.filter(F.col("reason").isNotNull()).select("doc_id", "kind", "reason")


def normalize_documents(raw: DataFrame, kind: str, unknown: str = "drop", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parse, check and split into (valid, quarantine)."""
    return split_documents(parse_documents(raw, kind, unknown, value), kind)


# --- the same checks on structured input -----------------------------------------------------------------

def batch_problems(batches: DataFrame) -> DataFrame:
    """Batch invariants on already structured documents: 1 to 600 samples, end not before start, sequence >= 0."""
    size = F.size(F.coalesce("samples", F.array().cast(batches.schema["samples"].dataType)))
    return batches.select(
        "batch_id", size.cast("bigint").alias("n_samples"),
        ((size >= 1) & (size <= MAX_SAMPLES)).alias("size_ok"),
        (F.col("ended_at") >= F.col("started_at")).alias("order_ok"),
        (F.col("sequence") >= 0).alias("sequence_ok"))


def suspected_problems(suspected: DataFrame) -> DataFrame:
    """Score and snapshot ratio within [0, 1], sequence not negative; absent values take their defaults."""
    score = F.coalesce("score", F.lit(0.0))
    ratio = F.coalesce("features.valid_sample_ratio", F.lit(0.0))
    sequence = F.coalesce("sequence", F.lit(0).cast("bigint"))
    return suspected.select("event_id", _share(score).alias("score_ok"), _share(ratio).alias("ratio_ok"),
                            _count(sequence).alias("sequence_ok"))


def decision_problems(decisions: DataFrame) -> DataFrame:
    """A response may not precede its detection."""
    return decisions.select("event_id", (F.col("responded_at") >= F.col("detected_at")).alias("order_ok"))


def resolve_identity(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add the document id, the single user id over all spellings (null when none), and whether they conflict."""
    pairs = _plain_entries(F.col(value))
    ids = user_ids(pairs)
    return raw.withColumns({
        "doc_id": document_id(pairs),
        "user_id": F.when(F.size(ids) == 1, F.try_element_at(ids, F.lit(1))),
        "identity_mismatch": F.size(ids) > 1,
    })
