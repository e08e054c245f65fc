"""Leakage-safe train/val/test assignment of whole groups."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.labels import TARGET
from pulseframe.params import ScaleParams, SplitParams
from pulseframe.session import cut_lineage

GROUP_COLUMNS = {"session": "session_id", "user": "user_id"}
SPLITS = ("train", "val", "test")


def group_hash(group: str, seed: int) -> Column:
    """The draw of a group: reproducible in any engine, independent of row order and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(group).cast("string"), F.lit("None"))))


@dataclass(frozen=True)
class GroupSplit:
    """Two hash bounds. Assigning a row is a comparison, so the data itself is never joined or shuffled."""

    group: str
    seed: int
    test_until: str  # groups drawn up to here are test ...
    val_until: str   # ... then up to here validation, the rest train
    n_groups: int
    n_test: int
    n_val: int

    def column(self) -> Column:
        draw = group_hash(self.group, self.seed)
        return F.when(draw <= self.test_until, "test").when(draw <= self.val_until, "val").otherwise("train")

    def assign(self, df: DataFrame) -> DataFrame:
        return df.withColumn("split", self.column())


def split_sizes(n_groups: int, test_size: float, val_size: float) -> tuple[int, int]:
    """Test takes ceil(test * n) groups; validation takes its share of the remainder, also rounded up."""
    n_test = math.ceil(test_size * n_groups)
    relative = val_size / (1 - test_size) if test_size < 1.0 else 0.0
    n_val = math.ceil(relative * (n_groups - n_test)) if relative > 0 else 0
    if n_test + n_val >= n_groups:
        raise ValueError(f"{n_groups} groups leave no training group for test {test_size} and val {val_size}")
    return n_test, n_val


# A draw is hexadecimal; three more digits cut the draws that are left into 4,096 parts.
_DIGITS, _DRAW_LENGTH = 3, 32


def draws_at(draws: DataFrame, ranks: Sequence[int], scale: ScaleParams = ScaleParams()) -> dict[int, str]:
    """Rank -> draw of distinct draws in ascending order, by counting prefixes until few draws are left to gather.

    ``draws`` is read once per pass; ranks outside the draws are left out.
    """
    found, length = {}, 0
    open_ranks = {rank: ("", 0) for rank in ranks if rank >= 0}  # rank -> (prefix of its draw, draws before that prefix)
    while open_ranks:
        prefixes = sorted({prefix for prefix, _ in open_ranks.values()})
        inside = draws.filter(F.substring("draw", 1, length).isin(prefixes)) if length else draws
        length += _DIGITS
        # At most 4,096 rows per prefix, and no more prefixes than ranks.
        parts: dict[str, list[tuple[str, int]]] = {}
        for row in inside.groupBy(F.substring("draw", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():
            parts.setdefault(row["p"][:length - _DIGITS], []).append((row["p"], row["n"]))
        narrowed, sizes = {}, {}
        for rank, (prefix, before) in open_ranks.items():
            for part, n in parts.get(prefix, []):
                if rank < before + n:
                    narrowed[rank], sizes[part] = (part, before), n
                    break
                before += n
        open_ranks = narrowed
        if not sizes or (max(sizes.values()) > scale.quantile_gather and length < _DRAW_LENGTH):
            continue
        few = inside.filter(F.substring("draw", 1, length).isin(sorted(sizes))).orderBy("draw").collect()
        for rank, (part, before) in open_ranks.items():
            found[rank] = [r["draw"] for r in few if r["draw"].startswith(part)][rank - before]
        break
    return found


def fit_group_split(df: DataFrame, params: SplitParams = SplitParams(), group: str | None = None,
                    scale: ScaleParams = ScaleParams()) -> GroupSplit:
    """Find the two draws that bound test and validation; the draws themselves are not sorted."""
    group = group or GROUP_COLUMNS[params.group_by]
    if group not in df.columns:
        raise ValueError(f"column '{group}' is not in the dataset")
    draws = cut_lineage(df.select(group_hash(group, params.seed).alias("draw")).distinct())
    n = draws.count()
    n_test, n_val = split_sizes(n, params.test_size, params.val_size)
    wanted = [n_test - 1, n_test + n_val - 1]
    bounds = draws_at(draws, wanted, scale)
    return GroupSplit(group, params.seed, bounds.get(wanted[0], ""), bounds.get(wanted[1], ""), n, n_test, n_val)


def group_split(df: DataFrame, params: SplitParams = SplitParams(), group: str | None = None,
                scale: ScaleParams = ScaleParams()) -> DataFrame:
    """The rows with their ``split``."""
    return fit_group_split(df, params, group, scale).assign(df)


def split_report(df: DataFrame, group: str = "user_id", label: str = TARGET) -> DataFrame:
    """Rows, groups, class counts per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(group).alias("n_groups"),
        F.count_if(F.col(label) == 0).alias("n_negative"), F.count_if(F.col(label) == 1).alias("n_positive"))


def group_overlap(df: DataFrame, group: str = "user_id") -> DataFrame:
    """Groups two splits have in common, per pair; all must be 0. One aggregation, no self join."""
    inside = df.groupBy(group).agg(*[F.max(F.when(F.col("split") == s, 1).otherwise(0)).alias(s) for s in SPLITS])
    pairs = [("train", "val"), ("train", "test"), ("val", "test")]
    row = inside.agg(*[F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{a}_vs_{b}") for a, b in pairs])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(f"{a}_vs_{b}").alias("pair"), F.col(f"{a}_vs_{b}").alias("n_common")) for a, b in pairs])).alias("r")).select("r.*")
