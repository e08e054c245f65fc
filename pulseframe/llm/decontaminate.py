"""Benchmark decontamination by q-gram lemma filtering.

Texts and items are lower-cased, every run of ASCII characters other than letters and digits is one space, and edits are counted
on the UTF-8 bytes of that form. An item of m bytes may differ by k = min(m * edit_share, (m - q) / q) edits. An occurrence with at
most k edits shares at least T = m - q + 1 - k q of its q-grams with the text, and its diagonals (text minus item position)
stay within k, so inside one of the overlapping bands of width 2 (k + 1) that start at every multiple of k + 1. Shared q-grams are
counted per document, item and band; only regions with T of them are verified, by banded alignment of the item against the
region with free ends. With q = 8 a q-gram is one 64-bit number, so nothing is approximate: no occurrence within the budget is lost.

Items are read in blocks of about ``block_bytes``, each sent to all tasks, with one pass over the documents for a block: no exchange.
What a block finds is written before the next one is collected, so the driver holds one block at a time.
Items shorter than q must occur as whole words. Null and empty items match nothing; null and empty texts have no match. Whole texts
are searched. Repeated documents and items each have their own rows; null doc_id and item_id stay null. Empty tables give no
rows. Other columns are not used.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm import kernel
from pulseframe.llm.common import stored

Q = 8
_HASH, _BITS = np.uint64(0x9E3779B97F4A7C15), 22
_PIECE = 500_000  # expanded hits held at once


@dataclass(frozen=True)
class DecontaminationParams:
    edit_share: float = 0.08
    block_bytes: int = 1_000_000


def normalised(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each text starts, one more for the end): each text begins and ends with one space."""
    data, starts = kernel.joined([b" " + x for x in run])
    data = kernel._LOWER[data]
    gap = kernel.PUNCTUATED[data]
    data[gap] = 32
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    keep[0] = True
    keep[starts[:-1]] = True
    # An item or text begins with its own space even where the one before ends with one.
    place = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], place[starts]


def grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each position as one number."""
    x = data.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] | (x[width:] << np.uint64(8 * width)) if len(x) > width else x[:0]
    return x


class ItemIndex:
    """All q-grams of a block of items, with their items and positions."""

    def __init__(self, texts: tuple[bytes, ...], edit_share: float):
        data, starts = normalised([x.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass") for x in texts])
        self.items = [data[a:b].tobytes().strip() for a, b in zip(starts, starts[1:])]
        self.size = np.array([len(x) for x in self.items], np.int64)
        self.budget = np.maximum(0, np.minimum((self.size * edit_share).astype(np.int64), (self.size - Q) // Q))
        self.least = self.size - Q + 1 - self.budget * Q
        self.short = [i for i, n in enumerate(self.size) if 0 < n < Q]
        parts = [(grams(np.frombuffer(x, np.uint8)), i) for i, x in enumerate(self.items) if len(x) >= Q]
        gram = np.concatenate([g for g, _ in parts]) if parts else np.zeros(0, np.uint64)
        item = np.repeat([i for _, i in parts], [len(g) for g, _ in parts]).astype(np.int64)
        at = np.concatenate([np.arange(len(g)) for g, _ in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(gram, kind="stable")
        self.gram, first = np.unique(gram[order], return_index=True)
        self.first = np.append(first, len(gram))
        self.item, self.at = item[order], at[order]
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.gram * _HASH) >> np.uint64(64 - _BITS)] = True

    def matches(self, run: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, begin in the normalised text) of every text and item that match; the fewest edits, the earliest."""
        data, starts = normalised(run)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for doc, item, band in self.regions(data, starts):
            m, k = int(self.size[item]), int(self.budget[item])
            low, high = int(starts[doc]), int(starts[doc + 1])
            if best.get((doc, item), (1, 0))[0] == 0:  # bands come in order: no later region is better
                continue
            begin = max(low, band * (k + 1))
            end = min(high, (band + 2) * (k + 1) + m + k)
            edits = alignment(self.items[item], data[begin:end], k)
            if edits is not None:
                key, new = (doc, item), (edits, begin - low)
                best[key] = min(best.get(key, new), new)
        for doc in range(len(run) if self.short else 0):
            text = data[starts[doc] : starts[doc + 1]].tobytes()
            for item in self.short:
                at = (text + b" ").find(b" " + self.items[item] + b" ")
                if at >= 0:
                    best[doc, item] = (0, at + 1)
        return [(doc, item, edits, begin) for (doc, item), (edits, begin) in sorted(best.items())]

    def regions(self, data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, band) with at least as many shared q-grams as the lemma asks."""
        if not len(self.gram):
            return
        g = grams(data)
        here = np.flatnonzero(self.maybe[(g * _HASH) >> np.uint64(64 - _BITS)])
        place = np.minimum(np.searchsorted(self.gram, g[here]), len(self.gram) - 1)
        real = self.gram[place] == g[here]
        here, place = here[real], place[real]
        doc = np.searchsorted(starts, here, side="right") - 1
        whole = here + Q <= starts[doc + 1]
        here, place, doc = here[whole], place[whole], doc[whole]
        times = self.first[place + 1] - self.first[place]
        offset = int(self.size.max()) + 1
        width = len(data) + offset + 2
        # Hits are expanded in pieces of bounded size and counted per band, so a text of one repeated q-gram costs its bands only.
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(times) // _PIECE, prepend=0)) if len(times) else []
        for a, b in zip([0, *cuts], [*cuts, len(here)]):
            spread = np.repeat(np.arange(a, b), times[a:b])
            entry = np.arange(len(spread)) - np.repeat(np.cumsum(times[a:b]) - times[a:b], times[a:b]) + np.repeat(self.first[place[a:b]], times[a:b])
            item = self.item[entry]
            # The band that starts here and the one before it hold the diagonal.
            band = (here[spread] - self.at[entry]) // (self.budget[item] + 1)
            more, n = np.unique((item * len(starts) + doc[spread]) * width + band + offset, return_counts=True)
            keys, back = np.unique(np.concatenate([keys, more]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
        both, place = np.unique(np.concatenate([keys, keys - 1]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([counts, counts]), minlength=len(both)).astype(np.int64)
        owner = both // width
        enough = total >= self.least[owner // len(starts)]
        for key in both[enough].tolist():
            pair, at = divmod(key, width)
            yield pair % len(starts), pair // len(starts), at - offset


def alignment(item: bytes, region: np.ndarray, budget: int) -> int | None:
    """Fewest edits that turn the item into some part of the region, or None beyond the budget.

    One row of the table per item byte, over the diagonals of the region only.
    """
    if item in region.tobytes():
        return 0
    if budget == 0:
        return None
    wide = len(region) - len(item) + 2 * budget + 1
    if wide <= 0:
        return None
    # Column d of row i is text position i + d - budget; positions outside never match.
    text = np.zeros(len(region) + 4 * budget + len(item) + 2, np.uint8)
    text[budget : budget + len(region)] = region
    ramp = np.arange(wide)
    row = np.zeros(wide, np.int64)
    for i, byte in enumerate(item):
        step = row + (text[i : i + wide] != byte)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - ramp) + ramp
        if row.min() > budget:
            return None
    # Padding never gives a cheaper end: a byte outside the region costs an edit like any other.
    best = int(row.min())
    return best if best <= budget else None


@functools.lru_cache(maxsize=2)
def _index(texts: tuple[bytes, ...], edit_share: float) -> ItemIndex:
    return ItemIndex(texts, edit_share)


def item_blocks(items: DataFrame, params: DecontaminationParams) -> Iterator[list[tuple[int | None, bytes]]]:
    """(item_id, text) in blocks of about ``block_bytes``, spread by a hash."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.length("text") > 0)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // params.block_bytes)
    for i in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield [(r["item_id"], r["text"].encode("utf-8", "surrogatepass")) for r in part.orderBy("item_id", "text").collect()]


def find_leaks(docs: DataFrame, items: DataFrame, params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """doc_id, item_id, edits int, begin int: every item found in every document, once, with its fewest edits."""
    schema = "doc_id long, item_id long, edits int, begin int"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items, params):
        names, texts = [i for i, _ in block], tuple(t for _, t in block)
        edit_share = params.edit_share

        def found(batches: Iterator[pd.DataFrame], names=names, texts=texts) -> Iterator[pd.DataFrame]:
            index = _index(texts, edit_share)
            for batch in batches:
                ids, lowered = batch["doc_id"].tolist(), [t.lower() if isinstance(t, str) else "" for t in batch["text"]]
                rows = [(ids[first + doc], names[item], edits, begin) for first, run in kernel.slices(lowered)
                        for doc, item, edits, begin in index.matches(run)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "begin"]).astype({"doc_id": "Int64", "item_id": "Int64"})

        out = out.unionByName(stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(found, schema), "leaks"))
    return out


def without_leaks(docs: DataFrame, items: DataFrame, params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """The rows of the documents whose text holds none of the items. Only texts with a leak are written, by two hashes."""
    key = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")]
    leaks = None
    for block in item_blocks(items, params):
        found = stored(docs.filter(~_free_of(tuple(t for _, t in block), params.edit_share)(F.col("text"))).select(*key), "leaking-texts")
        leaks = found if leaks is None else leaks.unionByName(found)
    if leaks is None:
        return docs
    rows = docs.select(F.struct("*").alias("row"), *key)
    return rows.join(leaks.distinct(), ["a", "b"], "left_anti").select("row.*")


def is_clean(items: DataFrame, text: str = "text", params: DecontaminationParams = DecontaminationParams()) -> Column:
    """Whether a text holds none of the items; a condition on each row, without an exchange, that carries all items.

    For benchmarks of many blocks take ``without_leaks``.
    """
    clean = F.lit(True)
    for block in item_blocks(items, params):
        clean = clean & _free_of(tuple(t for _, t in block), params.edit_share)(F.col(text))
    return clean


def _free_of(texts: tuple[bytes, ...], edit_share: float):
    @F.pandas_udf("boolean")
    def free(batch: pd.Series) -> pd.Series:
        index = _index(texts, edit_share)
        lowered = [t.lower() if isinstance(t, str) else "" for t in batch]
        out = np.ones(len(lowered), bool)
        for first, run in kernel.slices(lowered):
            out[[first + doc for doc, *_ in index.matches(run)]] = False
        return pd.Series(out)

    return free
