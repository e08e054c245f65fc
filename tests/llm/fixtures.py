"""Small hostile tables and brute-force versions."""

from __future__ import annotations

import random
import re

WORDS = "amber brook cedar delta ember frost grove haven inlet jetty knoll ledge marsh north ocean plain quiet ridge stone trail".split()
EXTRA = {"__id": "a", "score": "b", "rule": "c", "n": "d", "ids": "e", "host": "f", "component": "h"}
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(words))


def documents(spark, rows, schema="doc_id long, text string"):
    """Documents with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    return df.withColumns({name: F.lit(value) for name, value in EXTRA.items()})


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard_groups(rows, n, percent):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = union_find(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def dedup_lines(rows, width=3):
    """doc_id -> text, by plain loops over (doc_id, text) in order."""
    seen, gone, body = {}, {}, {}
    for i, text in sorted(rows):
        lines = [x.strip(" \t\n\r\x0b\x0c") for x in (text or "").split("\n")]
        body[i] = [x for x in lines if x]
        for k in range(len(body[i]) - width + 1):
            seen.setdefault(tuple(body[i][k : k + width]), []).append((i, k))
    for places in seen.values():
        first, at = places[0]
        for i, k in places[1:]:
            own = set(range(at, at + width)) if i == first else set()
            gone.setdefault(i, set()).update(set(range(k, k + width)) - own)
    out = {}
    for i, text in rows:
        kept, number = [], 0
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\r\x0b\x0c"):
                if number not in gone.get(i, ()):
                    kept.append(line)
                number += 1
            else:
                kept.append(line)
        out[i] = None if text is None else "\n".join(kept)
    return out


def normal(text):
    return re.sub(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", b" ", (text or "").lower().encode()).strip()


def edits_inside(item: bytes, text: bytes) -> int:
    """Fewest edits between the item and any part of the text: the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
