"""License scan: exact containment join of text blocks with license templates, in column expressions only.

Words are runs of letters, digits and non-ASCII characters after lower-casing A-Z. A document is cut into blocks of ``2 * stride``
words, one at every ``stride`` words, so any passage of up to ``stride + 1`` words lies whole in the block in whose first half it
starts. A block meets a template when it holds at least ``percent`` of the template's distinct words; for the phrases of the base
rules all of them, and then the places where the words stand in a row are read off the block.

The join is exact and filtered: words are ordered by the number of documents of the whole table that hold them, rarest first. With m
words in a template and o needed, the block must hold one of the template's m - o + 1 rarest words among its own |B| - o + 1 rarest
(prefix), |B| >= o (length), and the first shared word must leave room for o (position). A block's words outside all templates
can match nothing and take no part. Only survivors are intersected. The template side is a parameter of at most ``most_words`` words,
so its index is a literal; the documents never move, and the one exchange is that of the words' document counts.

A row gives one row, repeated rows and ids alike; null and empty texts have no words. A text without matches has null places, empty labels
and score 0. Extra columns stay; columns named like a result are replaced. An empty table gives no rows. Long texts are one row
with one array of words; nothing grows with the square of their length.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases of the base rules. Fixed values.
PHRASES: tuple[tuple[str, str], ...] = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Openings of public license notices, as words. Fixed values.
NOTICES: tuple[tuple[str, str], ...] = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under the gnu general public license version", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("licensed under cc by nc", "cc"),
    ("this work is licensed under a creative commons attribution", "cc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
)


@dataclass(frozen=True)
class ScanParams:
    percent: int = 80
    stride: int = 32
    most_words: int = 2_000
    phrases: tuple[tuple[str, str], ...] = PHRASES
    notices: tuple[tuple[str, str], ...] = NOTICES


@dataclass(frozen=True)
class Template:
    """Words as written, distinct words rarest first, how many must be shared, and the label they give."""

    words: tuple[str, ...]
    ordered: tuple[str, ...]
    needed: int
    label: str
    phrase: bool


def words_of(text: str | Column) -> Column:
    """Array of a text's words; null is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.translate(F.coalesce(column, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def document_counts(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """Documents of the whole table that hold each word of the vocabulary: at most one row per word reaches the driver."""
    held = docs.select(F.explode(F.array_intersect(words_of(text), _texts(vocabulary))).alias("word"))
    return {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def ordered_templates(params: ScanParams, counts: dict[str, int]) -> list[Template]:
    def rank(word: str) -> tuple[int, str]:
        return counts.get(word, 0), word

    out = []
    for texts, percent, phrase in ((params.phrases, 100, True), (params.notices, params.percent, False)):
        for text, label in texts:
            words = tuple(text.split())
            if phrase and len(words) > params.stride + 1:
                raise ValueError(f"a phrase has at most stride + 1 = {params.stride + 1} words: {text!r}")
            distinct = tuple(sorted(set(words), key=rank))
            out.append(Template(words, distinct, ceil(len(distinct) * percent / 100), label, phrase))
    return out


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def meets(block: Column, template: Template) -> Column:
    """Whether a block, its template words rarest first, holds enough of the template: three filters, then the count."""
    size, m, needed = F.size(block), len(template.ordered), template.needed
    prefix = _texts(template.ordered[: m - needed + 1])
    own = F.slice(block, F.lit(1), F.greatest(size - F.lit(needed - 1), F.lit(0)))
    first = F.get(F.array_intersect(prefix, own), F.lit(0))
    in_template, in_block = F.array_position(_texts(template.ordered), first), F.array_position(block, first)
    room = F.lit(1) + F.least(F.lit(m) - in_template, size - in_block)
    return (size >= needed) & F.arrays_overlap(own, prefix) & (room >= needed) & (F.size(F.array_intersect(block, _texts(template.ordered))) >= needed)


def scan_licenses(docs: DataFrame, params: ScanParams = ScanParams(), text: str = "text") -> DataFrame:
    """The same rows with n_words, n_base, first_word, last_word, base_labels, labels, score and matches.

    ``matches`` lists (label, first word of the block, share of the template's words) of every block that meets a notice.
    """
    vocabulary = sorted({w for t, _ in (*params.phrases, *params.notices) for w in t.split()})
    if len(vocabulary) > params.most_words:
        raise ValueError(f"templates hold {len(vocabulary)} words, most_words is {params.most_words}")
    counts = document_counts(docs, text, vocabulary)
    templates = ordered_templates(params, counts)
    ordered = _texts(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))
    prefixes = sorted({w for t in templates for w in t.ordered[: len(t.ordered) - t.needed + 1]})
    stride = params.stride

    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches")
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), words_of(F.col(f"`{text}`")).alias("words"))
    starts = F.when(F.arrays_overlap("words", _texts(prefixes)), F.sequence(F.lit(0), F.size("words") - 1, F.lit(stride)))
    blocks = F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.array_intersect(ordered, F.slice("words", s + 1, F.lit(2 * stride))).alias("held")))
    rows = rows.withColumn("blocks", F.filter(blocks, lambda b: F.size(b["held"]) > 0))

    def places(template: Template) -> Column:
        def here(p: Column) -> Column:
            at = F.lit(True)
            for k, word in enumerate(template.words):
                at = at & F.get("words", p + F.lit(k)).eqNullSafe(F.lit(word))
            return at

        found = F.filter("blocks", lambda b: meets(b["held"], template))
        return F.flatten(F.transform(found, lambda b: F.filter(F.sequence(b["start"], b["start"] + F.lit(stride - 1)), here)))

    def matched(template: Template) -> Column:
        found = F.filter("blocks", lambda b: meets(b["held"], template))
        share = lambda b: F.size(F.array_intersect(b["held"], _texts(template.ordered))) / F.lit(float(len(template.ordered)))
        return F.transform(found, lambda b: F.struct(
            F.lit(template.label).alias("label"), b["start"].cast("long").alias("word"), share(b).alias("share")))

    none = F.array().cast("array<int>")
    phrases = [t for t in templates if t.phrase]
    rows = rows.withColumns({f"p{k}": F.coalesce(places(t), none) for k, t in enumerate(phrases)})
    notices = [F.coalesce(matched(t), F.array().cast("array<struct<label:string,word:bigint,share:double>>")) for t in templates if not t.phrase]
    rows = rows.withColumn("matches", F.concat(*notices) if notices else F.array().cast("array<struct<label:string,word:bigint,share:double>>"))
    rows = rows.select(
        "row", "matches", F.size("words").alias("n_words"), F.concat(*[F.col(f"p{k}") for k in range(len(phrases))]).alias("places") if phrases else none.alias("places"),
        (F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(t.label)) for k, t in enumerate(phrases)])) if phrases else _texts([])).alias("base"))
    return rows.select(
        *[F.col(f"row.`{c}`") for c in kept], F.col("n_words").cast("long"), F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.col("matches.label"))), ",").alias("labels"),
        F.greatest(F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.lit(0.0)), F.coalesce(F.array_max("matches.share"), F.lit(0.0))).alias("score"), "matches")
