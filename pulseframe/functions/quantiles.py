"""Exact quantiles by counting: values are never exchanged or sorted, only counts of bins are.

A first pass counts the values of all groups in logarithmic bins. The bin that holds a wanted rank is then cut into equal parts
between its smallest and largest value, again and again, until the value is settled or so few are left that they are
gathered. A pass reads the rows once and exchanges at most its bins per task, for all groups and ranks together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.scale import broadcast_if_small, join_same
from pulseframe.params import ScaleParams
from pulseframe.session import cut_lineage

# First pass: bins per doubling of the magnitude, numbered around a middle above 32 * 1075 so that signs stay apart.
_PER_OCTAVE, _MIDDLE, _INFINITE, _NAN = 32, 40_000, 100_000, 110_000
_INF = float("inf")


def coarse_bin(x: Column) -> Column:
    """Number of a logarithmic bin, never falling with x; zero, both infinities and NaN (the largest) have their own."""
    size = F.abs(x)
    step = F.floor(F.log2(F.when(size < _INF, size)) * _PER_OCTAVE) + _MIDDLE
    return (F.when(F.isnan(x), F.lit(_NAN)).when(x == _INF, F.lit(_INFINITE)).when(x == -_INF, F.lit(-_INFINITE))
            .when(x == 0, F.lit(0)).when(x > 0, step).otherwise(-step)).cast("bigint")


def _inside(rows: DataFrame, brackets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows between the ends of one of their group's brackets; the brackets of a group do not overlap."""
    other = brackets.withColumnsRenamed({c: f"__b_{c}" for c in by})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__b_{c}")) for c in by])
    between = (F.col("__x") >= F.col("__lo")) & (F.col("__x") <= F.col("__hi"))
    return rows.join(other, on & between).drop(*[f"__b_{c}" for c in by])


def _settled() -> Column:
    """The value at the rank where a bracket's ends give it away."""
    rank, lo, hi = F.col("__rank"), F.col("__lo"), F.col("__hi")
    return (F.when((lo == hi) | (rank == F.col("__before")), lo)
            .when(rank == F.col("__before") + F.col("__n") - 1, hi))


def _holds_rank() -> Column:
    return (F.col("__before") <= F.col("__rank")) & (F.col("__rank") < F.col("__before") + F.col("__n"))


def _at_ranks(rows: DataFrame, by: list[str], brackets: DataFrame, scale: ScaleParams) -> DataFrame:
    """(by, __rank, __value) of every wanted rank, from the bracket (__lo, __hi, __before, __n) that holds it."""
    done: list[DataFrame] = []
    while True:
        state = brackets.withColumn("__value", _settled())
        done.append(state.filter(F.col("__value").isNotNull()).select(*by, "__rank", "__value"))
        state = state.filter(F.col("__value").isNull()).drop("__value")
        left = state.agg(F.count(F.lit(1)).alias("ranks"), F.max("__n").alias("largest")).first()
        if not left["ranks"]:
            break
        wanted = broadcast_if_small(state.select(*by, "__lo", "__hi").distinct(), left["ranks"], scale)
        inside = _inside(rows, wanted, by)
        if left["largest"] <= scale.quantile_gather:
            values = inside.groupBy(*by, "__lo").agg(F.array_sort(F.collect_list("__x")).alias("__values"))
            place = (F.col("__rank") - F.col("__before") + 1).cast("int")
            done.append(join_same(state, values, [*by, "__lo"])
                        .select(*by, "__rank", F.element_at("__values", place).alias("__value")))
            break
        share = (F.col("__x") - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))
        part = F.least(F.floor(share * scale.quantile_bins), F.lit(scale.quantile_bins - 1))
        parts = inside.groupBy(*by, "__lo", part.alias("__part")).agg(
            F.count(F.lit(1)).alias("__m"), F.min("__x").alias("__low"), F.max("__x").alias("__high"))
        earlier = Window.partitionBy(*by, "__lo").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("__skip", F.coalesce(F.sum("__m").over(earlier), F.lit(0)))
        # One row per wanted rank: what a pass over the rows found is kept, so that none is repeated.
        found = join_same(state.drop("__n"), parts, [*by, "__lo"]).select(
            *by, "__rank", (F.col("__before") + F.col("__skip")).alias("__before"), F.col("__m").alias("__n"),
            F.col("__low").alias("__lo"), F.col("__high").alias("__hi"))
        brackets = cut_lineage(found.filter(_holds_rank()))
    return reduce(DataFrame.unionByName, done)


def distribution(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
                 scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Per group: count, mean, std, min, max and exact interpolated quantiles of the non-null values.

    ``by`` names at least one column. ``df`` is read once per pass, so hand over a stored frame or a cheap one. Null groups
    are groups; NaN is the largest value; groups without any value give no row.
    """
    by = list(by)
    rows = df.filter(F.col(value).isNotNull()).select(*by, (F.col(value).cast("double") + F.lit(0.0)).alias("__x"))
    x = F.col("__x")
    bins = cut_lineage(rows.groupBy(*by, coarse_bin(x).alias("__bin")).agg(
        F.count(F.lit(1)).alias("__n"), F.avg(x).alias("__mean"), F.var_pop(x).alias("__var"),
        F.min(x).alias("__lo"), F.max(x).alias("__hi")))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    n, total = F.col("__n"), F.col("__total")
    bins = bins.withColumns({
        "__before": F.coalesce(F.sum(n).over(earlier), F.lit(0)), "__total": F.sum(n).over(group),
        "__centre": F.sum(F.col("__mean") * n).over(group) / F.sum(n).over(group)})

    def place(p: float) -> Column:
        return F.lit(float(p)) * (total - 1)

    off = F.col("__mean") - F.col("__centre")
    spread = F.sum(n * (F.col("__var") + off * off))
    most = F.max(total)
    summary = bins.groupBy(*by).agg(
        most.alias("__total"), F.max("__centre").alias("mean"),
        F.when(most > 1, F.sqrt(spread / (most - 1))).alias("std"), F.min("__lo").alias("min"), F.max("__hi").alias("max"))
    if not probs:
        return summary.withColumnRenamed("__total", "count").select(*by, "count", "mean", "std", "min", "max")
    ranks = F.array_distinct(F.array(*[side(place(p)) for p in probs.values() for side in (F.floor, F.ceil)]))
    brackets = (bins.withColumn("__rank", F.explode(ranks)).filter(_holds_rank())
                .select(*by, "__rank", "__before", "__n", "__lo", "__hi"))
    found = _at_ranks(rows, by, brackets, scale)
    values = join_same(found, summary.select(*by, "__total"), by).groupBy(*by).agg(*[
        F.max(F.when(F.col("__rank") == side(place(p)), F.col("__value"))).alias(f"__{tag}_{q}")
        for q, p in probs.items() for tag, side in (("lo", F.floor), ("hi", F.ceil))])
    got = join_same(summary, values, by)

    def between(q: str, p: float) -> Column:
        low, high = F.col(f"__lo_{q}"), F.col(f"__hi_{q}")
        return (low + (high - low) * (place(p) - F.floor(place(p)))).alias(q)

    return got.select(*by, total.alias("count"), "mean", "std", "min", *[between(q, p) for q, p in probs.items()], "max")
