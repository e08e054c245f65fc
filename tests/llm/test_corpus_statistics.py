"""License scan, importance resampling and phrase mining against plain loops."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from pulseframe.llm import license_scan, phrases, resample
from pulseframe.llm.queries import QUERIES, SQL
from tests.llm.fixtures import ASCII_LOWER, EXTRA, documents, prose
from tests.oracle import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_resample", "op13_phrases"])
def test_equals_sql(spark, name):
    got, want = QUERIES[name](spark, SMALL).toPandas(), connect(SMALL).execute(SQL[name]).df()
    assert difference(got, want) is None


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def licensed_rows():
    rng = random.Random(4)
    notices = [t for t, _ in license_scan.NOTICES]
    rows = []
    for i in range(60):
        words = prose(rng, rng.randrange(0, 120)).split()
        for _ in range(rng.randrange(0, 4)):
            piece = rng.choice([*notices, "MIT License", "Apache  License", "general\tpublic license", "license mit", "public general license"]).split()
            if len(piece) > 6:  # a notice with lost and foreign words: some meet the threshold, some do not
                for _ in range(rng.randrange(0, 7)):
                    piece[rng.randrange(len(piece))] = rng.choice(["x", "the", "license"])
            at = rng.randrange(len(words) + 1)
            words[at:at] = piece
        rows.append((i, " ".join(words)))
    long = "mit license " * 5_000 + notices[0]
    rows += [(60, None), (61, ""), (62, " .,"), (None, "mit license"), (7, "mit license"), (7, "mit license"), (63, long), (64, "MIT LICENSE." + "É" * 50),
             (65, "mit licenses"), (66, "smit license"), (67, "mit\nlicense"), (68, "mit" + "x " * 31 + "mit license")]
    return rows


def plain_scan(text, params):
    w = plain_words(text)
    places, base, labels, score = [], set(), set(), 0.0
    for phrase, label in params.phrases:
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    for notice, label in params.notices:
        t = set(notice.split())
        for s in range(0, len(w), params.stride):
            held = len(t & set(w[s : s + 2 * params.stride]))
            if 100 * held >= params.percent * len(t):
                labels.add(label)
                score = max(score, held / len(t))
    score = 1.0 if places else score
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score)


@pytest.mark.parametrize("params", [license_scan.ScanParams(), license_scan.ScanParams(percent=60, stride=20), license_scan.ScanParams(percent=100)])
def test_license_scan_equals_loops(spark, params):
    rows = licensed_rows()
    df = documents(spark, rows)
    got = license_scan.scan_licenses(df, params).collect()
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) for r in got), key=key) == \
        sorted(((i, *plain_scan(t, params)) for i, t in rows), key=key)
    assert all(got[0][k] == v for k, v in EXTRA.items() if k != "score")
    for r in got:
        assert {m["label"] for m in r["matches"]} <= set(r["labels"].split(","))


def test_license_scan_odd(spark):
    df = documents(spark, [(1, "mit license")])
    assert license_scan.scan_licenses(df.limit(0)).count() == 0
    bare = license_scan.scan_licenses(df, license_scan.ScanParams(phrases=(), notices=())).first()
    assert (bare["n_words"], bare["n_base"], bare["labels"], bare["score"]) == (2, 0, "", 0.0)
    with pytest.raises(ValueError):
        license_scan.scan_licenses(df, license_scan.ScanParams(most_words=3))


def test_running_crc():
    rng = np.random.RandomState(1)
    for size in (0, 1, 5, 511, 512, 513, 5_000):
        data = rng.randint(0, 256, size).astype(np.uint8)
        states = resample.running_crc(data)
        assert len(states) == size + 1
        for _ in range(20):
            a, b = sorted(rng.randint(0, size + 1, 2))
            full = np.array([0xFFFFFFFF], np.uint32)
            crc = resample.shifted(states[a : a + 1] ^ full, np.array([b - a])) ^ states[b : b + 1] ^ full
            assert int(crc[0]) == zlib.crc32(data[a:b].tobytes())


def resample_rows():
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(0, 60))) for i in range(150)]
    return rows + [(200, None), (201, ""), (None, prose(rng, 40)), (3, rows[3][1]), (3, prose(rng, 30)), (202, "É-é ÉCOLE x1 " * 20), (203, "w" * 40_000 + " a" * 9_000)]


def plain_features(text, params):
    w = plain_words(text)
    return [" ".join(w[i : i + n]) for n in range(params.shortest, params.longest + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("params", [resample.ResampleParams(), resample.ResampleParams(shortest=1, longest=3, buckets=97, percent=35, least_words=5)])
def test_resample_equals_loops(spark, params):
    rng = random.Random(2)
    rows, target = resample_rows(), [prose(rng, 25) for _ in range(10)] + [None, ""]
    bucket = lambda f: zlib.crc32(f.encode()) % params.buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, plain_features(text, params)))
    for text in target:
        t.update(map(bucket, plain_features(text, params)))
    all_s, all_t = sum(s.values()), sum(t.values())
    want = []
    for i, text in rows:
        f = plain_features(text, params)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + params.buckets) / ((s[b] + 1) * (all_t + params.buckets)))) for b in map(bucket, f)]
        weight = math.floor(Fraction(sum(gains), len(f))) if f else 0
        h = int(hashlib.sha256(f"{params.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        want.append((i, len(plain_words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((w for w in want if w[1] >= params.least_words), key=lambda w: (-w[4], w[0] is None, w[0] or 0))
    drawn = len(able) * params.percent // 100
    got = resample.resample(documents(spark, rows), spark.createDataFrame([(x,) for x in target], "text string"), params).collect()
    key = lambda w: tuple(map(str, w))
    assert sorted(((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in got), key=key) == sorted(want, key=key)
    ranked = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["rank"])
    assert [r[0] for r in ranked] == list(range(1, drawn + 1))
    assert [(r[1], r[2]) for r in ranked] == [(w[0], w[4]) for w in able[:drawn]]


def test_resample_empty(spark):
    df, none = documents(spark, [(1, "a b")]), spark.createDataFrame([], "text string")
    assert resample.resample(df.limit(0), none).count() == 0
    only = resample.resample(df, none).first()
    assert (only["n_features"], only["rank"]) == (2, None)


def phrase_rows(seed, langs=("en", "fr", None)):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(25)]
    rows = []
    for i in range(400):
        text, size = [], rng.randrange(0, 40)
        while len(text) < size:
            text += rng.choice([["alpha", "beta"], ["alpha", "beta", "gamma"], ["one", "two", "three", "four"], [rng.choice(vocabulary)], [rng.choice(vocabulary)]])
            if rng.random() < 0.1:
                text[-1] += rng.choice(".,;\n:")
        rows.append((rng.choice(langs), " ".join(text)))
    return rows + [("en", None), ("en", ""), ("en", " \t"), ("und", "alpha beta " * 30), ("de", "É é " * 20), ("en", "aa " * 3_000), ("fr", "ALPHA\tBETA  gamma")] * 2


def plain_phrases(rows, params):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in (1, 2, 3):
                f.update((lang or "und", *w[i : i + size]) for i in range(len(w) - size + 1))
    found = {}
    for p, a in f.items():
        if len(p) > 2 and a >= params.least:
            cuts = [(1_000_000 * a * a // (f[p[: k + 1]] * f[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
            score, k = min(cuts)
            found[p] = (a, f[p[: k + 1]], f[(p[0], *p[k + 1 :])], score)
    out = {}
    for p, (a, left, right, score) in found.items():
        longer = [found[q][0] for q in found if len(q) > len(p) and q[0] == p[0] and any(q[i : i + len(p) - 1] == p[1:] for i in range(1, len(q)))]
        if not any(100 * x >= params.absorb_percent * a for x in longer):
            out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), a, left, right, n[p[0]], score))
    return {(lang, k + 1, x[2].decode(), *x[3:]) for lang, rows in out.items() for k, x in enumerate(sorted(rows)[: params.top])}


@pytest.mark.parametrize("params", [
    phrases.PhraseParams(), phrases.PhraseParams(least=3, top=4), phrases.PhraseParams(least=2, top=25, absorb_percent=90),
    phrases.PhraseParams(least=3, top=6, bits=512), phrases.PhraseParams(least=5, top=10, id_bits=9, chunk_words=7)])
def test_phrases_equal_loops(spark, params):
    rows = phrase_rows(5)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    got = phrases.mine_phrases(documents_like(df), params).collect()
    assert len(got) == len(set(got))
    assert {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got} == plain_phrases(rows, params)


def documents_like(df):
    from pyspark.sql import functions as F

    return df.withColumns({"n": F.lit("x"), "w1": F.lit(0), "id": F.lit("y")})


def test_phrases_empty(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.mine_phrases(empty).count() == 0


def test_scores_pass_64_bits(spark):
    big = 9 * 10**12
    df = spark.createDataFrame([(big, big + 7, big + 9)], "a long, l long, r long")
    assert df.select(phrases._score("a", "l", "r")).first()[0] == 10**6 * big * big // ((big + 7) * (big + 9))
