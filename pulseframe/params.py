"""Run parameters as frozen dataclasses.

The defaults are fixed values: they decide results and are stored with every saved model.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields


@dataclass(frozen=True)
class ScaleParams:
    """Physical limits. They change how work is split, never what comes out."""

    max_rows_per_task: int = 2_000_000  # a key with more rows is split over several tasks
    broadcast_rows: int = 200_000       # a side with more rows is never broadcast
    quantile_bins: int = 4096           # parts that a bin with a wanted rank is cut into
    quantile_gather: int = 32_768       # values that may be gathered once a wanted rank is narrowed down to them


@dataclass(frozen=True)
class WindowParams:
    size_seconds: float = 60.0
    stride_seconds: float = 30.0
    min_samples: int = 10
    min_hr_ratio: float = 0.3


@dataclass(frozen=True)
class CleanParams:
    hr_fill_rows: int = 60
    temp_fill_rows: int = 300
    outlier_sigma: float = 3.0
    rolling_rows: int = 10
    rolling_min: int = 3
    outlier_min: int = 5


@dataclass(frozen=True)
class EventWindowParams:
    size_seconds: float = 60.0
    min_samples: int = 10
    min_hr_ratio: float = 0.3

    @classmethod
    def inherit(cls, window: WindowParams, **own) -> "EventWindowParams":
        """Size and minimum come from the sliding-window parameters unless given."""
        own.setdefault("size_seconds", window.size_seconds)
        own.setdefault("min_samples", window.min_samples)
        return cls(**own)


@dataclass(frozen=True)
class FeatureToggles:
    """Which window features appear, in output order."""

    hr_mean: bool = True
    hr_std: bool = True
    hr_min: bool = True
    hr_max: bool = True
    hr_slope_bpm_per_min: bool = True
    hrv_rmssd: bool = True
    hrv_sdnn: bool = True
    hrv_pnn50: bool = False
    ibi_available: bool = True
    ibi_coverage_ratio: bool = True
    movement_magnitude_mean: bool = False
    movement_variance_mean: bool = False
    skin_temp_mean: bool = True
    skin_temp_std: bool = False
    quality_good_ratio: bool = True
    quality_fair_ratio: bool = True
    quality_poor_ratio: bool = True
    valid_sample_ratio: bool = True
    window_duration_seconds: bool = True
    sample_count: bool = True
    last_sample_age_seconds: bool = False
    # Accepted for compatibility: a watch baseline is needed, so only the parity report computes it.
    hr_delta_from_baseline: bool = False

    def names(self) -> list[str]:
        return [f.name for f in fields(self)
                if f.name != "hr_delta_from_baseline" and getattr(self, f.name)]

    @classmethod
    def all_on(cls) -> "FeatureToggles":
        return cls(**{f.name: True for f in fields(cls)})


@dataclass(frozen=True)
class SplitParams:
    test_size: float = 0.2
    val_size: float = 0.1
    group_by: str = "session"
    seed: int = 42


@dataclass(frozen=True)
class LogisticParams:
    C: float = 1.0
    max_iter: int = 200
    class_weight: str | None = "balanced"


@dataclass(frozen=True)
class DummyParams:
    strategy: str = "prior"  # prior | constant | stratified | uniform
    constant: int = 0
    seed: int = 42


# The full metric list and the shorter one used when none is configured.
ALL_METRICS = (
    "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision",
    "balanced_accuracy", "specificity", "false_positive_rate",
)
FALLBACK_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")


@dataclass(frozen=True)
class MetricParams:
    metrics: tuple[str, ...] = ALL_METRICS
    threshold: float = 0.5


@dataclass(frozen=True)
class QaParams:
    missingness: float = 0.5
    min_rows: int = 10


@dataclass(frozen=True)
class ReadinessParams:
    min_rows: int = 10
    min_users: int = 2


@dataclass(frozen=True)
class RunParams:
    """Everything a saved model needs to rebuild its own inputs."""

    window: WindowParams = field(default_factory=WindowParams)
    clean: CleanParams = field(default_factory=CleanParams)
    event_window: EventWindowParams = field(default_factory=EventWindowParams)
    features: FeatureToggles = field(default_factory=FeatureToggles)
    split: SplitParams = field(default_factory=SplitParams)
    logistic: LogisticParams = field(default_factory=LogisticParams)
    dummy: DummyParams = field(default_factory=DummyParams)
    metrics: MetricParams = field(default_factory=MetricParams)

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, data: dict) -> "RunParams":
        parts = {}
        for f in fields(cls):
            kind = f.default_factory
            given = dict(data.get(f.name, {}))
            if f.name == "metrics" and "metrics" in given:
                given["metrics"] = tuple(given["metrics"])
            parts[f.name] = kind(**given)
        return cls(**parts)
