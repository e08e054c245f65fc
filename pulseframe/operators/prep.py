"""Model inputs: feature selection, missing-value indicators, imputation and scaling, fitted on train only.

Fitted statistics are a few numbers per feature. Applying them is plain column arithmetic, so it stays inside
code generation, works on streams, and is stored with the model as text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.functions.quantiles import distribution
from pulseframe.params import ScaleParams
from pulseframe.schemas import FEATURE_SCHEMA, FORBIDDEN_FEATURES

# Features whose absence is a signal of its own, and features filled with zero.
MONITORED = ("hrv_rmssd", "hrv_sdnn", "hrv_pnn50", "ibi_available", "ibi_coverage_ratio")
ZERO_FILLED = ("ibi_available", "ibi_coverage_ratio")
_EPS = 2.220446049250313e-16


@dataclass(frozen=True)
class PrepStats:
    features: tuple[str, ...]       # selected inputs
    indicators: tuple[str, ...]     # inputs with a was_nan indicator
    fills: dict[str, float]
    means: dict[str, float]         # of inputs after filling, and of indicators
    scales: dict[str, float]

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, data: dict) -> "PrepStats":
        return cls(tuple(data["features"]), tuple(data["indicators"]), dict(data["fills"]), dict(data["means"]), dict(data["scales"]))

    def inputs(self) -> list[str]:
        """Columns before scaling, in model order."""
        return [*self.features, *[f"{f}_was_nan" for f in self.indicators]]

    def outputs(self) -> list[str]:
        return [f"z_{c}" for c in self.inputs()]


def numeric_columns(df: DataFrame, candidates: Sequence[str] | None = None) -> list[str]:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return [c for c in candidates if c in names] if candidates is not None else [c for c in names if c not in FORBIDDEN_FEATURES]


def _finite_sql(col: str) -> str:
    return f"CASE WHEN NOT isnan(`{col}`) AND abs(`{col}`) < double('Infinity') THEN double(`{col}`) END"


def select_features(train: DataFrame, candidates: Sequence[str] | None = FEATURE_SCHEMA) -> list[str]:
    """Numeric candidates with at least one value in train; an error when none is left."""
    names = numeric_columns(train, candidates)
    if names:
        row = train.agg(*[F.count(F.expr(_finite_sql(c))).alias(c) for c in names]).first()
        names = [c for c in names if row[c] > 0]
    if not names:
        raise ValueError("no usable numeric feature in the training data")
    return names


def require_columns(df: DataFrame, features: Sequence[str]) -> None:
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"feature table lacks columns: {missing}")


def nan_indicators(df: DataFrame, monitored: Sequence[str] = MONITORED) -> DataFrame:
    """Add ``<feature>_was_nan`` (0/1) for each monitored feature that is present."""
    present = [f for f in monitored if f in df.columns]
    return df.withColumns({f"{f}_was_nan": F.expr(f"int(({_finite_sql(f)}) IS NULL)") for f in present}) if present else df


def fit_impute(train: DataFrame, features: Sequence[str], scale: ScaleParams = ScaleParams()) -> dict[str, float]:
    """Exact train median per feature; zero for the zero-filled and for features without any value."""
    fills = {f: 0.0 for f in features}
    medians = [f for f in features if f not in ZERO_FILLED]
    if medians:
        pairs = [F.struct(F.lit(f).alias("feature"), F.expr(_finite_sql(f)).alias("value")) for f in medians]
        long = train.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")
        # One row per feature.
        for row in distribution(long, ["feature"], "value", {"median": 0.5}, scale).collect():
            fills[row["feature"]] = float(row["median"])
    return fills


def impute(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    """Replace missing and infinite values by the fitted fill."""
    return df.withColumns({f: F.expr(f"coalesce({_finite_sql(f)}, {v!r}D)") for f, v in fills.items() if f in df.columns})


def fit_standardize(train: DataFrame, columns: Sequence[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population deviation per column; a constant column keeps scale 1."""
    row = train.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.var_pop(c).alias(f"v_{c}") for c in columns]).first()
    n, means, scales = row["__n"], {}, {}
    for c in columns:
        mean, var = float(row[f"m_{c}"] or 0.0), float(row[f"v_{c}"] or 0.0)
        constant = var <= n * _EPS * var + (n * mean * _EPS) ** 2
        means[c], scales[c] = mean, 1.0 if constant else var ** 0.5
    return means, scales


def standardize(df: DataFrame, means: dict[str, float], scales: dict[str, float]) -> DataFrame:
    return df.withColumns({f"z_{c}": (F.col(c) - F.lit(means[c])) / F.lit(scales[c]) for c in means})


def fit_prep(train: DataFrame, candidates: Sequence[str] | None = FEATURE_SCHEMA, scale: ScaleParams = ScaleParams()) -> PrepStats:
    features = select_features(train, candidates)
    indicators = [f for f in MONITORED if f in features]
    fills = fit_impute(train, features, scale)
    filled = impute(nan_indicators(train.select(*features), indicators), fills)
    means, scales = fit_standardize(filled, [*features, *[f"{f}_was_nan" for f in indicators]])
    return PrepStats(tuple(features), tuple(indicators), fills, means, scales)


def prep_sql(stats: PrepStats) -> dict[str, str]:
    """SQL of each scaled input: fill or indicate, then centre and scale."""
    def scaled(value: str, name: str) -> str:
        return f"(({value}) - {stats.means[name]!r}D) / {stats.scales[name]!r}D"

    out = {f"z_{f}": scaled(f"coalesce({_finite_sql(f)}, {stats.fills[f]!r}D)", f) for f in stats.features}
    out |= {f"z_{f}_was_nan": scaled(f"double(({_finite_sql(f)}) IS NULL)", f"{f}_was_nan") for f in stats.indicators}
    return out


def apply_prep(df: DataFrame, stats: PrepStats) -> DataFrame:
    """Add the scaled inputs ``z_*``; nothing is refitted."""
    require_columns(df, stats.features)
    return df.withColumns({name: F.expr(sql) for name, sql in prep_sql(stats).items()})
