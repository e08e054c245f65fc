"""Splitting hot keys, exact positions and running totals without a one-task sort.

Any key may hold a large share of all rows. A window function puts one key into one task, so every
ordered operator goes through :func:`ordered`: keys up to ``max_rows_per_task`` rows use a plain window
(one exchange on the key); larger keys are range-partitioned, numbered exactly, cut into chunks of fixed
length with the neighbouring rows they need, and windowed per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pulseframe.params import ScaleParams
from pulseframe.session import cut_lineage

# monotonically_increasing_id keeps the partition number above bit 33 and the row number below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def broadcast_if_small(df: DataFrame, rows: int, scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Broadcast hint only for a side whose counted size is within the bound; else a normal join side."""
    return F.broadcast(df) if rows <= scale.broadcast_rows else df


def join_same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on the named columns, with NULL equal to NULL; the columns of ``right`` besides them are added."""
    other = right.withColumnsRenamed({n: f"__same_{n}" for n in names})
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__same_{n}")) for n in names])
    return left.join(other, on, how).drop(*[f"__same_{n}" for n in names])


@dataclass(frozen=True)
class HotKeys:
    """Keys above the row limit, checkpointed, with their row total and number."""

    frame: DataFrame
    keys: int
    rows: int


def hot_keys(df: DataFrame, key: Sequence[str], scale: ScaleParams = ScaleParams()) -> HotKeys | None:
    """Find keys with more rows than one task should hold; None when there is none.

    One pre-aggregated pass over the key columns only. At most total_rows / limit keys can qualify.
    """
    hot = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
           .filter(F.col("__rows") > scale.max_rows_per_task))
    if hot.isEmpty():
        return None
    hot = cut_lineage(hot)
    total = hot.agg(F.count(F.lit(1)).alias("k"), F.sum("__rows").alias("n")).first()
    return HotKeys(hot.select(*key), total["k"], total["n"])


def split_hot(df: DataFrame, key: Sequence[str], hot: HotKeys, scale: ScaleParams) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys)."""
    side = broadcast_if_small(hot.frame, hot.keys, scale)
    return join_same(df, side, key, "left_anti"), join_same(df, side, key, "left_semi")


def number_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], partitions: int,
                groups: int, scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Exact 0-based position ``__rn`` of each row within its key, for keys of any size.

    Range partitioning balances by sampled order keys; a row id as the last range column lets even rows with
    equal keys spread. Positions are partition offsets plus the place inside the sorted partition.
    """
    laid = (df.withColumn("__tie", F.monotonically_increasing_id())
            .repartitionByRange(partitions, *key, *order, "__tie")
            .sortWithinPartitions(*key, *order, "__tie")
            .drop("__tie")
            .withColumn("__mid", F.monotonically_increasing_id()))
    laid = cut_lineage(laid)
    laid = (laid.withColumn("__pid", F.shiftright("__mid", _ROW_BITS))
            .withColumn("__idx", F.col("__mid").bitwiseAND(F.lit(_ROW_MASK))).drop("__mid"))
    parts = laid.groupBy(*key, "__pid").agg(F.min("__idx").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*key).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__skip", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).drop("__first", "__n")
    side = broadcast_if_small(parts, groups + partitions, scale)
    return (join_same(laid, side, [*key, "__pid"])
            .withColumn("__rn", F.col("__idx") + F.col("__skip")).drop("__pid", "__idx", "__skip"))


Carried = dict[str, tuple[Column, bool]]


def _carry_plain(df: DataFrame, window: WindowSpec, carried: Carried) -> DataFrame:
    frames = {True: window.rowsBetween(Window.unboundedPreceding, 0),
              False: window.rowsBetween(Window.unboundedPreceding, -1)}
    return df.withColumns({name: F.last(value, ignorenulls=True).over(frames[inclusive])
                           for name, (value, inclusive) in carried.items()}) if carried else df


def ordered(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    bounded: Callable[[DataFrame, WindowSpec], DataFrame] | None = None,
    before: int = 0,
    after: int = 0,
    carried: Carried | None = None,
    scale: ScaleParams = ScaleParams(),
    hot: HotKeys | str | None = "detect",
) -> DataFrame:
    """Add windowed columns per key, splitting keys that are too large for one task.

    ``bounded(df, window)`` may only use frames reaching ``before`` rows back and ``after`` rows ahead.
    ``carried`` maps an output name to (value, inclusive): the last non-null value so far, without a bound,
    with or without the current row. ``hot`` is the result of :func:`hot_keys`, None when the caller knows
    that no key is too large, or "detect".
    """
    key, order, carried = list(key), list(order), dict(carried or {})
    bounded = bounded or (lambda d, w: d)
    if hot == "detect":
        hot = hot_keys(df, key, scale)

    plain = Window.partitionBy(*key).orderBy(*order)
    if hot is None:
        return _carry_plain(bounded(df, plain), plain, carried)

    cold_rows, hot_rows = split_hot(df, key, hot, scale)
    cold = _carry_plain(bounded(cold_rows, plain), plain, carried)

    length = max(scale.max_rows_per_task, before + after + 1)
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-hot.rows // length))
    numbered = number_rows(hot_rows, key, order, partitions, hot.keys, scale)
    numbered = numbered.withColumn("__home", F.floor(F.col("__rn") / F.lit(length)))
    place = F.col("__rn") % F.lit(length)
    homes = F.array_compact(F.array(
        F.col("__home"),
        F.when(place >= length - before, F.col("__home") + 1),
        F.when((place < after) & (F.col("__home") > 0), F.col("__home") - 1)))
    pieces = numbered.withColumn("__chunk", F.explode(homes))
    chunked = Window.partitionBy(*key, "__chunk").orderBy("__rn")
    pieces = bounded(pieces, chunked)
    values = {f"__v_{name}": value for name, (value, _) in carried.items()}
    pieces = pieces.withColumns(values) if values else pieces
    pieces = _carry_plain(pieces, chunked, {f"__in_{name}": (F.col(f"__v_{name}"), inclusive)
                                            for name, (_, inclusive) in carried.items()})
    pieces = pieces.filter(F.col("__chunk") == F.col("__home")).drop("__home")
    if carried:
        ends = pieces.groupBy(*key, "__chunk").agg(*[
            F.max_by(f"__v_{name}", F.when(F.col(f"__v_{name}").isNotNull(), F.col("__rn"))).alias(f"__end_{name}")
            for name in carried])
        earlier = Window.partitionBy(*key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(*key, "__chunk", *[
            F.last(f"__end_{name}", ignorenulls=True).over(earlier).alias(f"__from_{name}") for name in carried])
        side = broadcast_if_small(ends, hot.keys + hot.rows // length, scale)
        pieces = join_same(pieces, side, [*key, "__chunk"])
        pieces = pieces.withColumns({name: F.coalesce(F.col(f"__in_{name}"), F.col(f"__from_{name}")) for name in carried})
    return cold.unionByName(pieces.select(*cold.columns))


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: Sequence[str],
                   scale: ScaleParams = ScaleParams()) -> DataFrame:
    """Add ``before_<c>``: the total of column c over all earlier rows of the same ``by`` group.

    For rows that are already aggregated to one per (by, order). Two passes over range partitions: totals per
    partition, then a running sum inside each partition on top of the partition's offset. No group, and no
    global order, ever sits in one task.
    """
    by, order = list(by), list(order)
    laid = (df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
            .withColumn("__pid", F.shiftright(F.monotonically_increasing_id(), _ROW_BITS)))
    laid = cut_lineage(laid)
    offsets = laid.groupBy(*by, "__pid").agg(*[F.sum(c).alias(f"__sum_{c}") for c in sums])
    # At most one row per range partition and group; ordered by partition number.
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select(*by, "__pid", *[
        F.coalesce(F.sum(f"__sum_{c}").over(earlier), F.lit(0)).alias(f"__off_{c}") for c in sums])
    inside = Window.partitionBy(*by, "__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    laid = laid.withColumns({f"__in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    left, right = laid.alias("l"), offsets.alias("r")
    keys = [*by, "__pid"]
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    return left.join(right, on).select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[(F.col(f"l.__in_{c}") + F.col(f"r.__off_{c}")).alias(f"before_{c}") for c in sums])


def match_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Rows with columns of their group's single row, null-safe on the group; without a group, from the one row."""
    if not by:
        one = groups.first()
        return rows.withColumns({c: F.lit(one[c]).cast(groups.schema[c].dataType) for c in take})
    left, right = rows.alias("l"), groups.alias("r")
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in by])
    return left.join(right, on).select("l.*", *[f"r.{c}" for c in take])
