"""Quality: a regularised quadratic discriminant over transformed statistics of whole texts.

Statistics are shares of byte kinds, word and line lengths, and repetition of words and lines; shares are taken to log-odds
and sizes to logarithms. Each class has a mean and a covariance shrunk towards the pooled one and its own diagonal; the
Cholesky factors are kept in the model, so a score is two triangular solves: the difference of the Mahalanobis log densities plus
the log odds of the classes, through the logistic function.

Class moments are summed over all labelled training rows by Spark; only sums of one row's size reach the driver. Labels
other than 0 and 1 are ignored; repeated labels of one document count once (their largest). A null or empty text has the
statistics of no bytes and gets a score too; repeated rows score alike; an empty table gives no rows. A class with no
training row falls back to the pooled moments, so scores are then the smoothed share of classes. Other columns are kept
apart by doc_id only; lang, source, doc_id and labels are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm import kernel

_KIND = np.zeros(256, np.int64)  # 0 other scripts, 1 lower, 2 upper, 3 digit, 4 sentence marks, 5 other marks, 6 space, 7 line feed
for _b in range(128):
    _c = chr(_b)
    _KIND[_b] = (1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 7 if _c == "\n" else
                 6 if _c.isspace() or not _c.isprintable() else 4 if _c in ".,;:?'\"-()" else 5)
NAMES = ("log_bytes", "log_words", "upper", "digit", "sentence_marks", "other_marks", "line_feeds", "other_script",
         "log_word_bytes", "log_word_bytes_spread", "distinct_words", "distinct_pairs", "distinct_lines", "log_line_words", "short_words")


@dataclass(frozen=True)
class QualityParams:
    shrink_pooled: float = 0.1
    shrink_diagonal: float = 0.05
    floor: float = 1e-3


@dataclass(frozen=True)
class QualityModel:
    """Means and lower Cholesky factors by class, log determinants, log odds of the classes."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_odds: float


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log((part + 0.5) / (whole - part + 0.5))


def statistics(texts: list[str | None]) -> np.ndarray:
    """(text, statistic) over whole texts."""
    parts = []
    for _, run in kernel.slices(texts):
        data, starts = kernel.joined(run)
        n = len(run)
        owner = np.repeat(np.arange(n), np.diff(starts))
        kinds = np.bincount(owner * 8 + _KIND[data], minlength=n * 8).reshape(n, 8).astype(float)
        kinds[:, 7] -= 1  # the separator after each text
        size = kinds.sum(axis=1)
        inside = _KIND[data] < 6
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        word_owner = np.searchsorted(starts, begin, side="right") - 1
        count = np.bincount(word_owner, minlength=n).astype(float)
        length = (end - begin).astype(float)
        total = np.bincount(word_owner, weights=length, minlength=n)
        square = np.bincount(word_owner, weights=length**2, minlength=n)
        mean = total / np.maximum(count, 1)
        spread = np.sqrt(np.maximum(square / np.maximum(count, 1) - mean**2, 0))
        hashes = kernel.span_hashes(data, inside, begin, end)
        following = kernel.mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
        feeds = np.flatnonzero(data == 10)
        line_begin = np.concatenate([[0], feeds[:-1] + 1])
        line_hash = kernel.span_hashes(data, data != 10, line_begin, feeds)
        line_owner = np.searchsorted(starts, line_begin, side="right") - 1
        lines = np.bincount(line_owner, minlength=n).astype(float)
        parts.append(np.column_stack([
            np.log1p(size), np.log1p(count), _share(kinds[:, 2], size), _share(kinds[:, 3], size), _share(kinds[:, 4], size),
            _share(kinds[:, 5], size), _share(kinds[:, 7], size), _share(kinds[:, 0], size), np.log1p(mean), np.log1p(spread),
            _share(_distinct(word_owner, hashes, n), count), _share(_distinct(word_owner[:-1], following, n), np.maximum(count, 1)),
            _share(_distinct(line_owner, line_hash, n), lines), np.log1p(count / lines), _share(np.bincount(word_owner, weights=length <= 3, minlength=n), count),
        ]))
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return np.bincount(o[new], minlength=n).astype(float)


def add_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and ``stats`` array<double> of every row."""
    @F.pandas_udf("array<double>")
    def stats(batch: pd.Series) -> pd.Series:
        return pd.Series(list(statistics(batch.tolist())))

    return df.select("doc_id", stats(F.col(text)).alias("stats"))


def fit_quality(stats: DataFrame, labels: DataFrame, train: Column, params: QualityParams = QualityParams()) -> QualityModel:
    """Fit on (doc_id, stats) and labels (doc_id, quality) where ``train``, a condition on doc_id, holds."""
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & train)
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")))
    width = len(NAMES)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            x, label = np.array(batch["stats"].tolist()).reshape(-1, width), batch["label"].to_numpy()
            for c in (0, 1):
                own = x[label == c]
                sums[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pd.DataFrame({"label": np.repeat([0, 1], sums.shape[1]), "place": np.tile(np.arange(sums.shape[1]), 2), "value": sums.ravel()})

    rows = (stats.join(known, "doc_id").select("label", "stats").mapInPandas(moments, "label int, place int, value double")
            .groupBy("label", "place").agg(F.sum("value").alias("value")).collect())
    sums = np.zeros((2, 1 + width + width * width))
    for r in rows:
        sums[r["label"], r["place"]] = r["value"]
    return model_of(sums, params)


def model_of(sums: np.ndarray, params: QualityParams) -> QualityModel:
    """Shrunk means, Cholesky factors and log determinants from class sums."""
    width = len(NAMES)

    def parts(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean = s[1 : 1 + width] / max(s[0], 1)
        return mean, s[1 + width :].reshape(width, width) / max(s[0], 1) - np.outer(mean, mean)

    # The mean of the class covariances by their counts: the distance between the classes is no part of it.
    pooled_mean = parts(sums.sum(axis=0))[0]
    pooled = sum(s[0] * parts(s)[1] for s in sums) / max(sums[:, 0].sum(), 1)
    means, factors, dets = [], [], []
    for s in sums:
        mean, cov = parts(s) if s[0] else (pooled_mean, pooled)
        cov = (1 - params.shrink_pooled) * cov + params.shrink_pooled * pooled
        cov = (1 - params.shrink_diagonal) * cov + params.shrink_diagonal * np.diag(np.diag(cov)) + params.floor * np.eye(width)
        factor = np.linalg.cholesky(cov)
        means.append(mean)
        factors.append(factor)
        dets.append(2 * np.log(np.diag(factor)).sum())
    odds = np.log((sums[1, 0] + 0.5) / (sums[0, 0] + 0.5))
    return QualityModel(np.array(means), np.array(factors), np.array(dets), float(odds))


def log_density_difference(model: QualityModel, x: np.ndarray) -> np.ndarray:
    def density(c: int) -> np.ndarray:
        factor, away = model.factors[c], (x - model.means[c]).T
        for i in range(len(factor)):  # forward substitution
            away[i] = (away[i] - factor[i, :i] @ away[:i]) / factor[i, i]
        return -0.5 * ((away**2).sum(axis=0) + model.log_dets[c])

    return density(1) - density(0) + model.log_odds


def score_quality(stats: DataFrame, model: QualityModel) -> DataFrame:
    """Add score (0 to 1) and predicted (score >= 0.5) to rows with ``stats``."""
    @F.pandas_udf("double")
    def scored(batch: pd.Series) -> pd.Series:
        x = np.array(batch.tolist(), float).reshape(-1, len(NAMES))
        return pd.Series(1 / (1 + np.exp(-np.clip(log_density_difference(model, x), -40, 40))))

    return stats.withColumn("score", scored("stats")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
