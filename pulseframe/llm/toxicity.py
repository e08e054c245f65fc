"""Toxicity: a logistic classifier on words, regularised by counterfactual swaps of identity terms.

Each labelled sentence that mentions an identity term is paired with its copy in which every such term is swapped for the
next of its group. Training minimises log loss + l2 |w|^2 / 2 + counterfactual * mean((score(copy) - score(sentence))^2),
so a term that merely co-occurs with toxic labels gets no weight of its own, and neutral mentions are not flagged.

Features are the presence of selected words and word stems (leading bytes) anywhere in the whole text, lower-cased; doc_id, lang, source and labels are
never inputs of a score. The fit uses at most ``max_train_rows`` labelled rows, chosen by a hash of doc_id; the scores cover
every row. Labels other than 0 and 1 are ignored, repeated labels of one document count once (their largest).
A null or empty text has no words and scores like the bias; repeated rows score alike; an empty table gives no rows.
With one class or no labelled rows every score is the (smoothed) share of the toxic class. Extra columns stay; columns
named score or predicted are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm import kernel
from pulseframe.llm.common import stored

# Groups of identity terms; inside a group each can stand for any other. Fixed values of this classifier.
IDENTITY_GROUPS = (
    ("man", "woman"), ("men", "women"), ("boy", "girl"), ("boys", "girls"), ("male", "female"), ("father", "mother"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrant", "native", "refugee", "foreigner"), ("immigrants", "natives", "refugees", "foreigners"),
    ("disabled", "blind", "deaf"), ("old", "young"),
    ("mann", "frau"), ("männer", "frauen"), ("christen", "muslime", "juden"), ("ausländer", "einheimische"),
    ("homme", "femme"), ("hommes", "femmes"), ("chrétiens", "musulmans", "juifs"), ("étrangers", "immigrés"),
    ("hombre", "mujer"), ("hombres", "mujeres"), ("cristianos", "musulmanes", "judíos"), ("extranjeros", "inmigrantes"),
)
SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, term in enumerate(group)}
_TERM = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, SWAP), key=len, reverse=True)) + r")(?!\w)")
STEMS = (4, 5, 6, 7, 8)  # bytes of a word's beginning that are features besides the word
_SENTENCE = re.compile(r"[^.!?\n]+")


@dataclass(frozen=True)
class ToxicityParams:
    max_train_rows: int = 20_000
    terms: int = 1_000
    min_rows: int = 4
    min_z: float = 4.0
    l2: float = 2.0
    counterfactual: float = 4.0
    steps: int = 600


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted word hashes, their weights, and the bias."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float


def _hash_words(text: str) -> np.ndarray:
    return kernel.words_and_stems([text.lower().encode("utf-8", "surrogatepass")], STEMS)[0]


def term_hashes(term: str) -> list[int]:
    """The term and its stems."""
    return _hash_words(term).tolist()


def _swaps(text: str) -> list[tuple[list[int], list[int]]]:
    """(words lost, words gained) by swapping the terms of each sentence that has any."""
    out = []
    for sentence in _SENTENCE.findall(text):
        if _TERM.search(sentence):
            before = set(_hash_words(sentence).tolist())
            after = set(_hash_words(_TERM.sub(lambda m: SWAP[m.group()], sentence)).tolist())
            if before != after:
                out.append((sorted(before - after), sorted(after - before)))
    return out


def _signed(values: list[int]) -> list[int]:
    return np.array(values, np.uint64).astype(np.int64).tolist()


def word_rows(labelled: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """label, words array<long> (distinct), lost and gained array<array<long>> (one entry for each swapped sentence)."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lowered = [t.lower() if isinstance(t, str) else "" for t in batch[text]]
            labels, found = batch[label].tolist(), []
            for first, run in kernel.slices(lowered):
                hashes, owner = kernel.words_and_stems(run, STEMS)
                order = np.lexsort((hashes, owner))
                hashes, at = hashes[order], np.searchsorted(owner[order], np.arange(len(run) + 1))
                for i in range(len(run)):
                    pairs = _swaps(lowered[first + i])
                    found.append((labels[first + i], np.unique(hashes[at[i] : at[i + 1]]).astype(np.int64),
                                  [_signed(a) for a, _ in pairs], [_signed(b) for _, b in pairs]))
            yield pd.DataFrame(found, columns=["label", "words", "lost", "gained"])

    return labelled.select(F.col(text).alias(text), F.col(label).alias(label)).mapInPandas(
        rows, "label int, words array<long>, lost array<array<long>>, gained array<array<long>>")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int) -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents for which ``train`` holds, by a hash of doc_id."""
    known = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train)
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # Bounded by the limit: two numbers a row.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Fit on documents (doc_id, text) and labels (doc_id, toxic). ``train`` is a condition on doc_id."""
    rows = stored(word_rows(training_rows(docs, labels, "toxic", train, params.max_train_rows)), "toxic-words")
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"] or 0
    share = (toxic + 0.5) / (n + 1)
    if toxic == 0 or toxic == n:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    # Words whose share among toxic rows differs from chance, the most certain first.
    counts = rows.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("df"), F.sum("label").alias("hits")).filter(F.col("df") >= params.min_rows)
    p = toxic / n
    z = F.abs(F.col("hits") - F.col("df") * p) / F.sqrt(F.col("df") * p * (1 - p))
    picked = counts.withColumn("z", z).filter(F.col("z") >= params.min_z).orderBy(F.desc("z"), "word").limit(params.terms)
    chosen = {r["word"] for r in picked.select("word").collect()} | set(_signed([h for t in SWAP for h in term_hashes(t)]))
    hashes = np.unique(np.array(sorted(chosen), np.int64).astype(np.uint64))
    signed = {h: i for i, h in enumerate(hashes.astype(np.int64).tolist())}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            index = lambda values: [signed[v] for v in values if v in signed]
            yield pd.DataFrame({"label": batch["label"], "words": [index(w) for w in batch["words"]],
                                "lost": [[index(x) for x in s] for s in batch["lost"]],
                                "gained": [[index(x) for x in s] for s in batch["gained"]]})

    # At most max_train_rows rows of selected word numbers.
    data = rows.mapInPandas(place, "label int, words array<int>, lost array<array<int>>, gained array<array<int>>").collect()
    x_row = np.repeat(np.arange(len(data)), [len(r["words"]) for r in data])
    x_col = np.array([c for r in data for c in r["words"]], np.int64)
    y = np.array([r["label"] for r in data], float)
    swaps = [(a, b) for r in data for a, b in zip(r["lost"], r["gained"])]
    s_row = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b in swaps])
    s_col = np.array([c for a, b in swaps for c in (*a, *b)], np.int64)
    s_val = np.array([v for a, b in swaps for v in (*[-1.0] * len(a), *[1.0] * len(b))])
    weights, bias = descend(x_row, x_col, y, s_row, s_col, s_val, len(swaps), len(hashes), params)
    return ToxicityModel(hashes, weights, bias)


def descend(x_row: np.ndarray, x_col: np.ndarray, y: np.ndarray, s_row: np.ndarray, s_col: np.ndarray, s_val: np.ndarray,
            n_swaps: int, width: int, params: ToxicityParams) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent with a diagonal step size on the penalised loss; returns weights and bias."""
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    w, bias = np.zeros(width), float(np.log(share / (1 - share)))
    seen_w, seen_b = w.copy(), bias
    # The diagonal of absolute row sums bounds the curvature, so a step never overshoots by itself.
    reach = np.bincount(x_row, minlength=len(y)) + 1.0
    pull = 2 * params.counterfactual * len(y) / max(1, n_swaps)
    s_reach = np.bincount(s_row, weights=np.abs(s_val), minlength=n_swaps)
    curve = (0.25 * np.bincount(x_col, weights=reach[x_row], minlength=width)
             + pull * np.bincount(s_col, weights=np.abs(s_val) * s_reach[s_row], minlength=width) + params.l2)
    bias_curve = 0.25 * reach.sum()
    for t in range(params.steps):
        z = np.bincount(x_row, weights=seen_w[x_col], minlength=len(y)) + seen_b
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        miss = p - y
        grad = np.bincount(x_col, weights=miss[x_row], minlength=width) + params.l2 * seen_w
        if n_swaps:
            change = np.bincount(s_row, weights=s_val * seen_w[s_col], minlength=n_swaps)
            grad += pull * np.bincount(s_col, weights=s_val * change[s_row], minlength=width)
        new_w, new_b = seen_w - grad / curve, seen_b - miss.sum() / bias_curve
        if (new_w - w) @ grad + (new_b - bias) * miss.sum() > 0:  # overshoot: restart the momentum
            momentum, start = 0.0, t
        else:
            momentum = (t - start) / (t - start + 3) if t else 0.0
            start = start if t else 0
        seen_w, seen_b = new_w + momentum * (new_w - w), new_b + momentum * (new_b - bias)
        w, bias = new_w, new_b
    return w, float(bias)


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add score (0 to 1) and predicted (score >= 0.5)."""
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = np.full(len(batch), model.bias)
            lowered = [t.lower() if isinstance(t, str) else "" for t in batch]
            for first, run in kernel.slices(lowered):
                hashes, owner = kernel.words_and_stems(run, STEMS)
                if not len(hashes) or not len(model.hashes):
                    continue
                place = np.minimum(np.searchsorted(model.hashes, hashes), len(model.hashes) - 1)
                hit = np.flatnonzero(model.hashes[place] == hashes)
                pairs = np.unique(owner[hit] * len(model.hashes) + place[hit])
                out[first : first + len(run)] += np.bincount(
                    pairs // len(model.hashes), weights=model.weights[pairs % len(model.hashes)], minlength=len(run))
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -40, 40))))

    return df.withColumn("score", scored(F.col(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
