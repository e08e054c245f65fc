"""Quality report of a labelled dataset (the wide table of features, label and metadata)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.quantiles import distribution
from pulseframe.operators.labels import TARGET
from pulseframe.params import QaParams, ReadinessParams, ScaleParams
from pulseframe.schemas import FEATURE_SCHEMA

COUNTED = {
    "class": TARGET, "user": "user_id", "session": "session_id", "device": "device_id",
    "response": "response", "response_category": "response_category",
}
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def present_features(ds: DataFrame, features: Sequence[str] = FEATURE_SCHEMA) -> list[str]:
    return [f for f in features if f in ds.columns]


def _rows(pairs: Sequence[Column]) -> Column:
    return F.explode(F.array(*pairs)).alias("r")


def value_counts(ds: DataFrame) -> DataFrame:
    """(section, key, n) for class, user, session, device, response and category, nulls included; one pass."""
    pairs = [F.struct(F.lit(s).alias("section"), F.col(c).cast("string").alias("key"))
             for s, c in COUNTED.items() if c in ds.columns]
    return ds.select(_rows(pairs)).select("r.*").groupBy("section", "key").agg(F.count(F.lit(1)).alias("n"))


def feature_missingness(ds: DataFrame, params: QaParams = QaParams(), features: Sequence[str] = FEATURE_SCHEMA) -> DataFrame:
    """(feature, n_missing, missing_ratio, flagged): flagged above the threshold. Empty for an empty dataset."""
    names = present_features(ds, features)
    row = ds.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(f).isNull()).alias(f) for f in names])
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("n_missing")) for f in names]
    long = row.filter(F.col("__n") > 0).select("__n", _rows(pairs)).select("__n", "r.*")
    ratio = F.col("n_missing") / F.col("__n")
    return long.select("feature", "n_missing", ratio.alias("missing_ratio"), (ratio > params.missingness).alias("flagged"))


def ibi_coverage(ds: DataFrame) -> DataFrame:
    """One row: rows without IBI, mean availability, mean coverage."""
    has = "ibi_available" in ds.columns
    none = F.count_if(F.col("ibi_available") == 0) if has else F.count(F.lit(1))
    available = F.avg("ibi_available") if has else F.when(F.count(F.lit(1)) > 0, F.lit(0.0))
    ratio = F.avg("ibi_coverage_ratio") if "ibi_coverage_ratio" in ds.columns else F.max(F.lit(None).cast("double"))
    return ds.agg(none.alias("n_no_ibi"), available.alias("ibi_available_mean"), ratio.alias("ibi_coverage_ratio_mean"))


def describe_features(ds: DataFrame, features: Sequence[str] = FEATURE_SCHEMA, scale: ScaleParams = ScaleParams()) -> DataFrame:
    """(feature, count, mean, std, min, p25, p50, p75, max) with exact interpolated quartiles."""
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in present_features(ds, features)]
    return distribution(ds.select(_rows(pairs)).select("r.*"), ["feature"], "value", QUARTILES, scale)


def samples_per_window(ds: DataFrame, scale: ScaleParams = ScaleParams()) -> DataFrame:
    return describe_features(ds, ["sample_count"], scale)


def exclusions_by_reason(exclusions: DataFrame) -> DataFrame:
    """(reason, n), most frequent first; the reasons are a short fixed list."""
    return (exclusions.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason"))


def temporal_coverage(ds: DataFrame) -> DataFrame:
    """One row: first and last detection, span in seconds and days, distinct days."""
    span = (F.unix_micros(F.max("detected_at")) - F.unix_micros(F.min("detected_at"))) / F.lit(1e6)
    return ds.agg(F.min("detected_at").alias("first_at"), F.max("detected_at").alias("last_at"),
                  span.alias("span_seconds"), (span / F.lit(86400.0)).alias("span_days"),
                  F.count_distinct(F.to_date("detected_at")).alias("distinct_days"))


def qa_warnings(ds: DataFrame, params: QaParams = QaParams(), features: Sequence[str] = FEATURE_SCHEMA) -> DataFrame:
    """(warning, subject) rows: empty, single class, high missingness per feature, no IBI at all, small."""
    names = present_features(ds, features)
    n, n_ibi = F.col("__n"), F.col("__no_ibi")
    no_ibi = F.count_if(F.col("ibi_available") == 0) if "ibi_available" in ds.columns else F.count(F.lit(1))
    # Equal smallest and largest label means a single class; null labels form no class of their own here.
    row = ds.agg(F.count(F.lit(1)).alias("__n"), F.min(TARGET).alias("__low"), F.max(TARGET).alias("__high"),
                 no_ibi.alias("__no_ibi"), *[F.count_if(F.col(f).isNull()).alias(f) for f in names])

    def warn(name: str, subject: Column, condition: Column) -> Column:
        return F.when(condition, F.struct(F.lit(name).alias("warning"), subject.alias("subject")))

    nothing = F.lit("dataset")
    marks = [
        warn("empty_dataset", nothing, n == 0),
        warn("single_class", nothing, (n > 0) & F.col("__low").eqNullSafe(F.col("__high"))),
        *[warn("high_missingness", F.lit(f), (n > 0) & (F.col(f) > n * F.lit(params.missingness))) for f in names],
        warn("no_ibi", nothing, (n > 0) & (n_ibi == n)),
        warn("small_dataset", nothing, n < params.min_rows),
    ]
    return row.select(F.explode(F.array_compact(F.array(*marks))).alias("r")).select("r.*")


def dataset_qa(ds: DataFrame, exclusions: DataFrame, params: QaParams = QaParams(),
               features: Sequence[str] = FEATURE_SCHEMA, scale: ScaleParams = ScaleParams()) -> DataFrame:
    """The whole report as tidy rows (section, key, value); text-valued warnings carry value 1."""
    def tidy(df: DataFrame, section: Column, key: Column, value: Column) -> DataFrame:
        return df.select(section.alias("section"), key.alias("key"), value.cast("double").alias("value"))

    def wide(df: DataFrame, section: Column, stats: Sequence[str], prefix: Column | None = None) -> DataFrame:
        name = (lambda s: F.concat_ws(".", prefix, F.lit(s))) if prefix is not None else F.lit
        pairs = [F.struct(section.alias("section"), name(s).alias("key"), F.col(s).cast("double").alias("value")) for s in stats]
        return df.select(_rows(pairs)).select("r.*")

    size = ds.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(present_features(ds, features))).alias("n_features"))
    stats = ["count", "mean", "std", "min", *QUARTILES, "max"]
    when = temporal_coverage(ds).withColumns({
        "first_at": F.unix_micros("first_at") / F.lit(1e6), "last_at": F.unix_micros("last_at") / F.lit(1e6)})
    missing = feature_missingness(ds, params, features)
    return (wide(size, F.lit("size"), ["n_rows", "n_features"])
            .unionByName(tidy(value_counts(ds), F.concat(F.lit("counts_"), F.col("section")), F.col("key"), F.col("n")))
            .unionByName(tidy(missing, F.lit("missing_ratio"), F.col("feature"), F.col("missing_ratio")))
            .unionByName(wide(ibi_coverage(ds), F.lit("ibi_coverage"), ["n_no_ibi", "ibi_available_mean", "ibi_coverage_ratio_mean"]))
            .unionByName(wide(describe_features(ds, features, scale), F.lit("distribution"), stats, F.col("feature")))
            .unionByName(tidy(exclusions_by_reason(exclusions), F.lit("exclusions"), F.col("reason"), F.col("n")))
            .unionByName(wide(when, F.lit("temporal"), ["first_at", "last_at", "span_seconds", "span_days", "distinct_days"]))
            .unionByName(tidy(qa_warnings(ds, params, features), F.lit("warnings"), F.concat_ws(":", "warning", "subject"), F.lit(1))))


class NotReady(ValueError):
    """The dataset must not be trained on."""


def check_ready(ds: DataFrame, params: ReadinessParams = ReadinessParams(), group: str = "user_id") -> DataFrame:
    """(check, ok, found) rows of the readiness checks, from one aggregation.

    "aligned" holds when every row has a key, a label, and its key only once.
    """
    has_group = group in ds.columns
    users = F.count_distinct(group) if has_group else F.lit(0)
    row = ds.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(TARGET).alias("classes"), users.alias("users"),
                 F.count_distinct("event_id").alias("ids"), F.count(TARGET).alias("labels"))
    n, found = F.col("n"), F.least("ids", "labels")
    checks = {
        "not_empty": (n > 0, n),
        "aligned": ((F.col("ids") == n) & (F.col("labels") == n), found),
        "both_classes": (F.col("classes") >= 2, F.col("classes")),
        "has_group_column": (F.lit(has_group), F.lit(int(has_group))),
        "enough_users": (F.col("users") >= params.min_users, F.col("users")),
        "enough_rows": (n >= params.min_rows, n),
    }
    pairs = [F.struct(F.lit(c).alias("check"), ok.alias("ok"), v.cast("bigint").alias("found")) for c, (ok, v) in checks.items()]
    return row.select(_rows(pairs)).select("r.*")


def require_ready(ds: DataFrame, params: ReadinessParams = ReadinessParams(), group: str = "user_id") -> DataFrame:
    """Raise with every failing check listed; returns the report otherwise."""
    report = check_ready(ds, params, group)
    failed = report.filter(~F.col("ok")).collect()  # at most six rows
    if failed:
        raise NotReady("dataset is not ready: " + "; ".join(f"{r['check']} (found {r['found']})" for r in failed))
    return report
