"""Target-distribution importance resampling over hashed n-grams, hashed from running CRCs.

Texts are lower-cased (A-Z), their words joined by one space, and that stream is scanned once: a running CRC-32 is kept at every byte.
CRCs are linear over GF(2), so the CRC of any run of words follows from the two running values at its ends: the earlier one,
moved over the run's length by squared shift matrices, cancels what came before. No n-gram is cut out or hashed on its own.

Two passes: bucket counts of all texts of both tables (an array of counts per task, summed by bucket), then per document the floored mean of the
buckets' log-ratio gains, and a Gumbel key from a hash of seed and id. The highest keys are drawn without replacement: counts per
score give the lowest score drawn, and only rows from there on are range-sorted and numbered; nothing is ordered in one task.

The model is ``buckets`` integers, whatever the corpus. Null and texts without words have no features, weight 0 and are never drawn. A null
id is hashed as an empty text and ranks behind all ids of its score; rows that repeat an id count each, ties between them by a hash of the text.
Extra columns do not take part. Empty tables give no rows or, as target, counts of zero. Long texts are whole; a slice is bounded by the
longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scale import number_rows, running_totals
from pulseframe.llm import kernel
from pulseframe.llm.common import stored

_LANE = 512
_FULL = np.uint32(0xFFFFFFFF)
_POLYNOMIAL = 0xEDB88320  # CRC-32, bits reversed


@dataclass(frozen=True)
class ResampleParams:
    shortest: int = 1
    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024


@cache
def byte_table() -> np.ndarray:
    """CRC of each byte after a zero state."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & np.uint32(1), (x >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), x >> np.uint32(1))
    return x


@cache
def shift_tables() -> list[np.ndarray]:
    """Entry b moves a CRC over 2^b zero bytes: four tables, one for each byte of the CRC; each entry is the square of the one before."""
    one = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    tables = [byte_table()[one & np.uint32(255)] ^ (one >> np.uint32(8))]
    while len(tables) < 40:
        tables.append(np.stack([_apply(tables[-1], part) for part in tables[-1]]))
    return tables


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    m = np.uint32(255)
    return table[0][x & m] ^ table[1][(x >> np.uint32(8)) & m] ^ table[2][(x >> np.uint32(16)) & m] ^ table[3][x >> np.uint32(24)]


def shifted(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC states moved over ``lengths`` zero bytes: x times z^(8 * length) modulo the polynomial."""
    out, left, b = x.copy(), lengths.copy(), 0
    while len(left) and left.max():
        odd = np.flatnonzero(left & 1)
        out[odd] = _apply(shift_tables()[b], out[odd])
        left >>= 1
        b += 1
    return out


def running_crc(data: np.ndarray) -> np.ndarray:
    """States after 0, 1, ... bytes from a zero state. Lanes advance side by side, then each gets what came before it."""
    lanes = -(-len(data) // _LANE)
    laid = np.zeros(lanes * _LANE, np.uint8)
    laid[: len(data)] = data
    laid = np.ascontiguousarray(laid.reshape(lanes, _LANE).T)
    table, state, low = byte_table(), np.zeros(lanes, np.uint32), np.uint32(255)
    out = np.empty((_LANE, lanes), np.uint32)
    for k in range(_LANE):
        state = table[(state ^ laid[k]) & low] ^ (state >> np.uint32(8))
        out[k] = state
    over_lane = [[int(v) for v in part] for part in shift_tables()[_LANE.bit_length() - 1]]
    before, x = np.zeros(lanes, np.uint32), 0
    for j, end in enumerate(out[-1].tolist() if lanes else []):
        before[j] = x
        x = over_lane[0][x & 255] ^ over_lane[1][x >> 8 & 255] ^ over_lane[2][x >> 16 & 255] ^ over_lane[3][x >> 24] ^ end
    for k in range(_LANE):
        before = table[before & low] ^ (before >> np.uint32(8))
        out[k] ^= before
    return np.concatenate([np.zeros(1, np.uint32), out.T.reshape(-1)[: len(data)]])


def ngram_crcs(run: list[bytes], shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(CRC-32 of every n-gram, its text's number, words of each text) for a slice of texts."""
    data, starts = kernel.joined(run)
    data = kernel._LOWER[data]
    inside = ~kernel.PUNCTUATED[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(starts, begin, side="right") - 1
    # One byte behind each word stays, as the space between it and the next.
    keep = inside.copy()
    keep[end] = True
    stream = np.where(inside, data, np.uint8(32))[keep]
    length = end - begin
    start = np.cumsum(length + 1) - length - 1
    states = running_crc(stream)
    crcs, owners = [], []
    for n in range(shortest, longest + 1):
        count = max(0, len(begin) - n + 1)
        whole = owner[:count] == owner[n - 1 : n - 1 + count]
        a, b = start[:count][whole], (start + length)[n - 1 : n - 1 + count][whole]
        crcs.append(shifted(states[a] ^ _FULL, b - a) ^ states[b] ^ _FULL)
        owners.append(owner[:count][whole])
    return np.concatenate(crcs), np.concatenate(owners), np.bincount(owner, minlength=len(run))


def bucket_counts(texts: DataFrame, text: str, params: ResampleParams) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    shortest, longest, buckets = params.shortest, params.longest, params.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, run in kernel.slices(batch.column(0).to_pylist()):
                total += np.bincount(ngram_crcs(run, shortest, longest)[0] % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    return texts.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def fit_gains(docs: DataFrame, target: DataFrame, params: ResampleParams = ResampleParams(), text: str = "text") -> np.ndarray:
    """Floored 1000 * ln((t + 1)(S + B) / ((s + 1)(T + B))) of every bucket: ``buckets`` integers reach the driver."""
    spark = docs.sparkSession
    both = (bucket_counts(docs, text, params).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(bucket_counts(target, text, params).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))))
    every = spark.range(params.buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    summed = both.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    rows = summed.orderBy("bucket").limit(params.buckets).collect()
    s, t = (np.array([r[c] for r in rows], np.float64) for c in "st")
    ratio = (t + 1) * (s.sum() + params.buckets) / ((s + 1) * (t.sum() + params.buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def score_documents(docs: DataFrame, gains: np.ndarray, params: ResampleParams = ResampleParams(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, tie, n_words, n_features, weight, score) of every row."""
    shortest, longest, buckets = params.shortest, params.longest, np.uint32(params.buckets)

    @F.pandas_udf("n_words long, n_features long, total long")
    def summed(batch: pd.Series) -> pd.DataFrame:
        parts = []
        for _, run in kernel.slices(batch.tolist()):
            crcs, owner, words = ngram_crcs(run, shortest, longest)
            total = np.zeros(len(run), np.int64)
            np.add.at(total, owner, gains[crcs % buckets])
            parts.append(np.stack([words, np.bincount(owner, minlength=len(run)), total], axis=1))
        return pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, 3), np.int64), columns=["n_words", "n_features", "total"])

    key = F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    rows = docs.select(F.col(id_col), F.xxhash64(text).alias("tie"), h.alias("h"), summed(F.col(text)).alias("m")).select(id_col, "tie", "h", "m.*")
    rows = rows.withColumn("weight", F.expr("CASE WHEN n_features = 0 THEN 0L ELSE (total - pmod(total, n_features)) div n_features END"))
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((F.col("h") + 0.5) / F.lit(4294967296.0))))
    return rows.select(id_col, "tie", "n_words", "n_features", "weight", (F.col("weight") + noise).cast("long").alias("score"))


def resample(docs: DataFrame, target: DataFrame, params: ResampleParams = ResampleParams(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score and rank (null when it is not drawn)."""
    spark = docs.sparkSession
    scored = stored(score_documents(docs, fit_gains(docs, target, params, text), params, id_col, text), "resample-scores")
    able = scored.filter(F.col("n_words") >= params.least_words)
    drawn = able.count() * params.percent // 100
    # The lowest score drawn, from counts per score.
    levels = running_totals(able.groupBy((-F.col("score")).alias("level")).agg(F.count(F.lit(1)).alias("n")), [], ["level"], ["n"])
    cut = levels.filter(F.col("before_n") < drawn).agg(F.max("level").alias("level")).first()["level"]
    columns = [id_col, "n_words", "n_features", "weight", "score"]
    if cut is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    high = (F.col("n_words") >= params.least_words) & (F.col("score") >= -cut)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = able.filter(F.col("score") >= -cut).withColumns({"__down": -F.col("score"), "__late": F.col(id_col).isNull()})
    ranked = number_rows(order, [], ["__down", "__late", id_col, "tie"], partitions, 1)
    rank = F.when(F.col("__rn") < drawn, F.col("__rn") + 1).cast("long").alias("rank")
    return ranked.select(*columns, rank).unionByName(scored.filter(~high).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, ranks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents whose id was drawn, in any order; for tables whose ids name one row."""
    return docs.join(ranks.filter("rank IS NOT NULL").select(id_col), id_col, "left_semi")
