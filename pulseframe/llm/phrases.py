"""Phrase collocations per language by best-first branch-and-bound growth.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends, pieces into words at spaces and tabs. A phrase of two or
three words with at least ``least`` occurrences scores the lowest floor(10^6 a^2 / (l r)) over its cuts.

Growth goes from prefixes to longer phrases. A word's bound is 10^6, so all words that are frequent enough are grown first, to pairs.
For a triple with the prefix (x, y), f(x y z) is at most f(x y) and at most f(y z), so the cut after x gives a score of at most
10^6 f(x y) / f(x): the prefix's bound. The frontier of pairs is expanded in order of that bound: a round takes every pair down to the score
that ``2 * top`` pairs of its language reach, together with the triples that could absorb such a pair, and counts exactly those. It is settled
when ``top`` phrases survive at or above the round's lowest bound, since all that is not expanded scores less, ties included; a language
that is not settled goes eight times deeper, in the end to all pairs.

Counting runs over slices of texts as arrays: words are 64-bit hashes that are checked to be injective within each language (else
another seed is taken), phrases are tuples of them, so counts are exact. Two fixed-size bitmaps (``bits`` each) tell a
slice which words or pairs are worth counting; a false positive is only counted in vain, as all counts are joined exactly
afterwards. Slices are combined per task and then by phrase; no language or word is gathered in one task, and no table of the
corpus reaches the driver.

A null lang is ``und``. Null and empty texts have no words. Repeated rows count each. Extra columns do not take part. An empty table gives no
rows. A piece of any length is taken in chunks that overlap by two words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scale import number_rows, running_totals
from pulseframe.llm import kernel
from pulseframe.llm.common import stored

_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_APART = _BREAKS.copy()
_APART[[9, 32]] = True
_PAGE = 32_768  # bits of one bitmap row of Spark's bitmap functions


@dataclass(frozen=True)
class PhraseParams:
    least: int = 10
    absorb_percent: int = 50
    top: int = 2_000
    bits: int = 1 << 25  # of each bitmap: 4 MB
    id_bits: int = 64
    chunk_words: int = 1_000_000  # their cubes fit 63 bits


def word_ids(run: list[bytes], seed: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, end, id, number of its piece) of every word of a slice."""
    data, _ = kernel.joined(run)
    data = kernel._LOWER[data]
    inside = ~_APART[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ids = kernel.mix(kernel.span_hashes(data, inside, begin, end) + np.uint64(seed))
    if bits < 64:
        ids = ids & np.uint64((1 << bits) - 1)
    return data, begin, end, ids.view(np.int64), np.cumsum(_BREAKS[data])[begin]


def slot(lang: int, ids: list[np.ndarray], bits: int) -> np.ndarray:
    """Bit of a phrase; the same rule in both directions, here over arrays."""
    h = np.full(len(ids[0]), lang, np.int64).view(np.uint64)
    for part in ids:
        h = kernel.mix(h * np.uint64(0xD6E8FEB86659FD93) + part.view(np.uint64))
    return (h % np.uint64(bits)).astype(np.int64)


def _language_number(lang: str) -> int:
    data = np.frombuffer(lang.encode(), np.uint8)
    return int(kernel.span_hashes(data, np.ones(len(data), bool), np.array([0]), np.array([len(data)])).view(np.int64)[0])


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    langs, texts = batch.column(0).to_pylist(), batch.column(1)
    rows: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        rows.setdefault(lang, []).append(i)
    for lang, at in rows.items():
        for _, run in kernel.slices(texts.take(pa.array(at)).to_pylist()):
            yield lang, run


def _table(columns: dict[str, tuple[pa.DataType, object]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for t, v in columns.values()], list(columns))


def word_counts(docs: DataFrame, seed: int, params: PhraseParams) -> DataFrame:
    """(lang, id, word, n) over all words."""
    bits = params.id_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, run in by_language(batch):
                data, begin, end, ids, _ = word_ids(run, seed, bits)
                text = data.tobytes()
                if bits < 64:  # equal ids of different words must come out apart
                    spans = [text[b:e] for b, e in zip(begin.tolist(), end.tolist())]
                    words, n = np.unique(np.array(spans, object), return_counts=True) if spans else (np.array([], object), np.array([], int))
                    where = {w: i for w, i in zip(spans, ids.tolist())}
                    own, words = [where[w] for w in words], list(words)
                else:
                    own, first, n = np.unique(ids, return_index=True, return_counts=True)
                    words = [text[b:e] for b, e in zip(begin[first].tolist(), end[first].tolist())]
                if len(words):
                    yield _table({"lang": (pa.string(), [lang] * len(words)), "id": (pa.int64(), own),
                                  "word": (pa.binary(), words), "n": (pa.int64(), n)})

    found = docs.mapInArrow(count, "lang string, id long, word binary, n long")
    return found.groupBy("lang", "id", "word").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, size: int, words: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None, seed: int, params: PhraseParams) -> DataFrame:
    """(lang, w1 .. w<size>, n): phrases all of whose words pass the word bitmap and, for triples, the first pair the first or the last pair the second pair bitmap."""
    context = docs.sparkSession.sparkContext
    shared, shared_pairs = context.broadcast(words), context.broadcast(pairs)
    bits, id_bits, chunk, names = params.bits, params.id_bits, params.chunk_words, [f"w{k + 1}" for k in range(size)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, run in by_language(batch):
                number = _language_number(lang)
                _, _, _, ids, piece = word_ids(run, seed, id_bits)
                for at in range(0, len(ids), chunk - size + 1):
                    found = _counted(ids[at : at + chunk], piece[at : at + chunk], size, number)
                    if found is not None:
                        parts, n = found
                        yield _table({"lang": (pa.string(), [lang] * len(n)), **{c: (pa.int64(), p) for c, p in zip(names, parts)}, "n": (pa.int64(), n)})

    def _counted(ids: np.ndarray, piece: np.ndarray, size: int, number: int):
        here = len(ids) - size + 1
        if here <= 0:
            return None
        local, inverse = np.unique(ids, return_inverse=True)
        good = _hit(shared.value, slot(number, [local], bits))
        keep = piece[:here] == piece[size - 1 :]
        for k in range(size):
            keep &= good[inverse[k : k + here]]
        place = np.flatnonzero(keep)
        v = np.int64(len(local))
        if size == 3 and len(place):
            codes, back = np.unique(np.concatenate([inverse[place] * v + inverse[place + 1], inverse[place + 1] * v + inverse[place + 2]]), return_inverse=True)
            slots = slot(number, [local[codes // v], local[codes % v]], bits)
            head, tail = (_hit(m, slots) for m in shared_pairs.value)
            place = place[head[back[: len(place)]] | tail[back[len(place) :]]]
        if not len(place):
            return None
        code = inverse[place]
        for k in range(1, size):
            code = code * v + inverse[place + k]
        code, n = np.unique(code, return_counts=True)
        parts = []
        for _ in range(size):
            parts.append(local[code % v])
            code = code // v
        return parts[::-1], n

    found = docs.mapInArrow(count, ", ".join(["lang string", *[f"{c} long" for c in names], "n long"]))
    return found.groupBy("lang", *names).agg(F.sum("n").alias("n")).filter(F.col("n") >= params.least)


def _hit(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def bitmap(phrases: DataFrame, columns: list[str], params: PhraseParams) -> np.ndarray:
    """Bits of all given phrases; Spark builds it page by page, and ``bits`` / 8 bytes at most reach the driver."""
    bits = params.bits

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ids = np.array(batch.column(0).to_pylist(), object), [batch.column(k + 1).to_numpy() for k in range(len(columns))]
            for lang in set(langs.tolist()):
                own = langs == lang
                yield _table({"slot": (pa.int64(), slot(_language_number(lang), [i[own] for i in ids], bits) + 1)})

    placed = phrases.select("lang", *columns).mapInArrow(slots, "slot long")
    pages = placed.groupBy(F.bitmap_bucket_number("slot").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(-(-bits // _PAGE) * _PAGE // 8, np.uint8)
    for row in pages.collect():
        at = (row["page"] - 1) * _PAGE // 8
        out[at : at + _PAGE // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _score(a: str, left: str, right: str) -> Column:
    wide = "decimal(18,0)"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({a} as {wide}) * cast({a} as {wide})) div (cast({left} as {wide}) * cast({right} as {wide}))")


def thresholds(pairs: DataFrame, langs: DataFrame, depth: int) -> DataFrame:
    """(lang, low): the score that ``depth`` pairs of the language reach, 0 where it has fewer."""
    levels = pairs.groupBy("lang", (-F.col("score")).alias("level")).agg(F.count(F.lit(1)).alias("m"))
    reached = running_totals(levels, ["lang"], ["level"], ["m"]).filter(F.col("before_m") + F.col("m") >= depth)
    low = reached.groupBy("lang").agg(F.max(-F.col("level")).alias("low"))
    return langs.join(low, "lang", "left").select("lang", F.coalesce("low", F.lit(0)).cast("long").alias("low"))


def mine_phrases(docs: DataFrame, params: PhraseParams = PhraseParams(), text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of every language."""
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    seed = 0
    while True:
        words = stored(word_counts(docs, seed, params), "phrase-words")
        if words.groupBy("lang", "id").count().filter("count > 1").isEmpty():
            break
        seed += 1
    langs = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.filter(F.col("n") >= params.least)
    known = bitmap(frequent, ["id"], params)
    one, two = (frequent.select("lang", F.col("id").alias(f"w{k}"), F.col("n").alias(f"f{k}")) for k in (1, 2))
    pairs = phrase_counts(docs, 2, known, None, seed, params).withColumnRenamed("n", "a").join(one, ["lang", "w1"]).join(two, ["lang", "w2"])
    pairs = stored(pairs.withColumns({"score": _score("a", "f1", "f2"), "bound": F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(18,0))) div cast(f1 as decimal(18,0))")}), "phrase-pairs")

    depth, low = 2 * params.top, None
    while True:
        deeper = thresholds(pairs, langs, depth)
        # A settled language keeps its threshold.
        low = stored(deeper if low is None else low.filter("settled").select("lang", "low").unionByName(
            deeper.join(low.filter("NOT settled").select("lang"), "lang")), "phrase-thresholds")
        reach = pairs.join(F.broadcast(low) if low.count() <= 10_000 else low, "lang")
        heads = bitmap(reach.filter("bound >= low"), ["w1", "w2"], params)
        tails = bitmap(reach.filter("score >= low"), ["w1", "w2"], params)
        triples = phrase_counts(docs, 3, known, (heads, tails), seed, params).withColumnRenamed("n", "a")
        head = pairs.select("lang", "w1", "w2", F.col("a").alias("f12"), "f1")
        tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("f2").alias("f3"))
        triples = triples.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
        triples = triples.withColumns({"s1": _score("a", "f1", "f23"), "s2": _score("a", "f12", "f3")})
        triples = stored(triples.select("lang", "w1", "w2", "w3", "a", F.least("s1", "s2").alias("score"),
                                        F.when(F.col("s1") <= F.col("s2"), F.col("f1")).otherwise(F.col("f12")).alias("l"),
                                        F.when(F.col("s1") <= F.col("s2"), F.col("f23")).otherwise(F.col("f3")).alias("r")), "phrase-triples")
        inside = triples.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
        inside = inside.groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("a").alias("longer"))
        alone = pairs.join(inside, ["lang", "w1", "w2"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {params.absorb_percent} * a"))
        found = alone.select("lang", "w1", "w2", F.lit(None).cast("long").alias("w3"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), "score").unionByName(triples)
        found = stored(found.join(F.broadcast(low) if low.count() <= 10_000 else low, "lang").filter("score >= low"), "phrase-found")
        done = found.groupBy("lang").agg(F.count(F.lit(1)).alias("m"))
        low = stored(low.select("lang", "low").join(done, "lang", "left").select(
            "lang", "low", (F.coalesce(F.col("m") >= params.top, F.lit(False)) | (F.col("low") == 0)).alias("settled")), "phrase-thresholds")
        if low.filter("NOT settled").isEmpty():
            break
        depth *= 8

    names = frequent.select("lang", "id", F.col("word").cast("string").alias("word"))
    for k in (1, 2, 3):
        found = found.join(names.select("lang", F.col("id").alias(f"w{k}"), F.col("word").alias(f"t{k}")), ["lang", f"w{k}"], "left" if k == 3 else "inner")
    found = found.select("lang", "a", "l", "r", "score", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), (-F.col("score")).alias("__s"), (-F.col("a")).alias("__a"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = number_rows(found, ["lang"], ["__s", "__a", "phrase"], partitions, 1_000).filter(F.col("__rn") < params.top)
    return ranked.join(langs, "lang").select("lang", (F.col("__rn") + 1).cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
