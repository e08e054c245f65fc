"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plausible inter-beat intervals in milliseconds, and the pNN50 step.
IBI_MIN_MS, IBI_MAX_MS = 250.0, 2000.0
NN_STEP_MS = 50.0
# Sums of squares are taken around this point; any value gives the same variance, this one keeps digits.
_IBI_CENTRE = 1000.0


def micros(seconds: float) -> int:
    """Seconds as whole microseconds, the unit of all window arithmetic."""
    return round(seconds * 1_000_000)


def finite_or_null(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL in every floating column; nothing is imputed."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    clean = {n: F.expr(f"CASE WHEN NOT isnan(`{n}`) AND abs(`{n}`) < double('Infinity') THEN `{n}` END") for n in floating}
    return df.withColumns(clean) if clean else df


def array_mean(col: Column) -> Column:
    """Mean of an array of doubles; null when it is empty."""
    total = F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(col) > 0, total / F.size(col))


def ibi_summary_struct(ibi: str = "ibi_ms") -> Column:
    """Per-sample IBI sums from which window HRV follows by addition.

    Covers plausible values only: count, centred sum and square sum, squared and large successive differences
    inside the sample, first and last value. Null exactly when the sample carries no value at all.
    """
    d, step = f"(x - {_IBI_CENTRE}D)", "coalesce(x - a.last, 0D)"
    return F.expr(f"""CASE WHEN size({ibi}) > 0 THEN aggregate(
        filter({ibi}, x -> x >= {IBI_MIN_MS}D AND x <= {IBI_MAX_MS}D),
        named_struct('n', 0L, 'd1', 0D, 'd2', 0D, 'ss', 0D, 'over', 0L, 'first', double(NULL), 'last', double(NULL)),
        (a, x) -> named_struct(
            'n', a.n + 1L, 'd1', a.d1 + {d}, 'd2', a.d2 + {d} * {d}, 'ss', a.ss + {step} * {step},
            'over', a.over + IF(abs({step}) > {NN_STEP_MS}D, 1L, 0L), 'first', coalesce(a.first, x), 'last', x)) END""")
