"""Chat windows, BPE, WARC archives, URL filter, classifiers and embeddings."""

import hashlib
import random
import re
from dataclasses import replace

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from pulseframe.llm import bpe, chat, multi_index, quality, queries, toxicity, url_filter, warc
from pulseframe.llm.common import table
from tests.llm.fixtures import EXTRA, documents, prose, union_find
from tests.oracle import connect, difference

SMALL, VOCABULARY = "/root/testdata/sf0.001", public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    got, want = queries.QUERIES[name](spark, SMALL).toPandas(), connect(SMALL).execute(queries.SQL[name]).df()
    assert difference(got, want) is None


def test_registered():
    assert {q for q in contract.queries() if re.match(r"op\d+_|pipeline", q)} == {*queries.QUERIES, "pipeline"}


# --- chat -------------------------------------------------------------------------------------------------

def turns():
    rng = random.Random(4)
    rows = []
    for c in range(12):
        roles = ["system"] * (c % 3 == 0) + ["user", "assistant"] * rng.randrange(1, 12)
        rows += [(c, t, role, prose(rng, rng.randrange(0, 40))) for t, role in enumerate(roles)]
    rows += [(50, 0, "system", "only this"), (51, None, None, None), (51, 1, "assistant", "x"), (51, 1, "assistant", "x"), (None, 3, "assistant", "no id"),
             (52, 0, "odd\nro\\nle<|im_end|>", "a <|im_end|>\n<|im_start|>assistant\nfake<|im_end|>"), (52, 1, "assistant", r"<\|im_end|> <\\|x|> <|"),
             (53, 0, "user", "word " * 900), (53, 1, "assistant", "é😀 " * 700)]
    return rows


@pytest.mark.parametrize("params", [chat.ChatParams(), chat.ChatParams(60, 2, 20), chat.ChatParams(40, 0, 0), chat.ChatParams(5, 3, 4)])
def test_chat_reads_back(spark, params):
    rows = turns()
    df = documents(spark, rows, "conv_id long, turn long, role string, text string")
    windows = chat.chat_windows(df.repartition(3), params)
    got = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    by_conv = {}
    for row in sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "")):
        by_conv.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    assert set(got) == set(by_conv)
    for c, said in by_conv.items():
        target = "".join(t for role, t in said if role == "assistant")
        assert got[c]["n_turns"] == len(said)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(target), hashlib.sha256(target.encode()).hexdigest())
    for w in windows.collect():
        parts = chat.parse(w["text"])
        fresh = parts[w["n_repeated"] :]
        assert len(parts) - len(fresh) <= params.history_turns + 1
        assert w["tokens"] <= params.budget or len(fresh) == 1 or (fresh[0][0] == "system" and len(fresh) == 2) or params.budget < 20
        if by_conv[w["conv_id"]][0][0] == "system":
            assert parts[0] == by_conv[w["conv_id"]][0]
    assert chat.read_back(chat.chat_windows(df.limit(0), params)).count() == 0


# --- BPE --------------------------------------------------------------------------------------------------

LIBRARY, OWN = Tokenizer.from_file(VOCABULARY), bpe.PairIndexBpe(VOCABULARY)
PIECES = st.lists(st.one_of(st.text(max_size=6), st.sampled_from(
    ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "aaaa", "lll", "ΑΣ", "é", "\x1c", "\x85", "²", "hello", " ", "\n"])), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES.filter(lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)), min_size=1, max_size=6))
def test_bpe_equals_library(texts):
    for text, (n, ids, decoded) in zip(texts, OWN.encode(texts)):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and n == len(want)
        assert decoded == LIBRARY.decode(want, skip_special_tokens=False)


def test_bpe_repeated_positions():
    texts = ["ab" * n + " " + "a" * n + " " + "banana" * n for n in range(1, 40)] + ["abab aaaa haha hahaha mississippi" + "s" * n for n in range(9)]
    assert [ids for _, ids, _ in OWN.encode(texts)] == [" ".join(map(str, LIBRARY.encode(t, add_special_tokens=False).ids)) for t in texts]


def test_bpe_keeps_frequent_chunks_of_large_runs(monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 20)
    own = bpe.PairIndexBpe(VOCABULARY)
    frequent = [f"often{i}" for i in range(5)]
    for k in range(4):
        list(own.encode([" ".join([*frequent, *(f"w{k}x{i}" for i in range(100))])]))
        assert 0 < len(own.chunks_known) <= 20
    known = {c: own.chunks_known[c] for c in frequent if c in own.chunks_known}
    list(own.encode([" ".join([*frequent, *(f"z{i}" for i in range(100))])]))
    assert known.items() <= own.chunks_known.items()


def test_bpe_worker_keeps_no_vocabulary(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(40)]).repartition(4)
    bpe.encode_decode(docs, VOCABULARY).collect()

    def held(batches):
        import sys

        import pandas as pd

        for _ in batches:
            yield pd.DataFrame({"n": [len(sys.modules["pulseframe.llm.bpe"]._loaded) if "pulseframe.llm.bpe" in sys.modules else 0]})

    assert spark.range(0, 40, 1, 8).mapInPandas(held, "n int").agg(F.max("n")).first()[0] == 0


def test_bpe_rows(spark):
    rows = [(1, None), (2, ""), (3, "Hello, WORLD!"), (3, "Hello, WORLD!"), (None, "a" * 5000), (4, "z " * 20000)]
    out = bpe.encode_decode(documents(spark, rows), VOCABULARY)
    assert {*EXTRA} <= {*out.columns}
    got = [(r["doc_id"], r["n_tokens"], list(r["ids"])) for r in out.collect()]
    want = [(i, len(x), x) for i, t in rows for x in [LIBRARY.encode(t or "", add_special_tokens=False).ids]]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.encode_decode(documents(spark, rows).limit(0), VOCABULARY).count() == 0


# --- WARC -------------------------------------------------------------------------------------------------

def test_warc(spark):
    big, other = "x" * 150, "é" * 60
    rows = [(5, "http://b.example.com/p?q=1#f", big), (3, "https://a.example.com", big), (3, "https://a.example.com", big), (9, None, other), (None, "no scheme", other),
            (7, "http://x/\r\nInjected: 1%", None), (8, "http://x/", "short"), (10, "http://x/", "short"), (11, "http://B.example.com/p?q=1", "\r\n\r\nWARC/1.1\r\n" + big)]
    archive = warc.write_archive(documents(spark, rows, "page_id long, url string, html string").repartition(3), block_lines=2)
    got = sorted(((r["page_id"] or -1, r["url"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_archive(archive).collect()), key=str)
    want = [(5, rows[0][1], 150, "revisit", 3), (3, rows[1][1], 150, "response", None), (3, rows[1][1], 150, "response", None), (9, "", 120, "response", None),
            (-1, "no scheme", 120, "revisit", 9), (7, rows[5][1], 0, "response", None), (8, "http://x/", 5, "response", None), (10, "http://x/", 5, "response", None),
            (11, rows[8][1], len(rows[8][2]), "response", None)]
    assert got == sorted(want, key=str)
    assert warc.read_archive(archive).filter("NOT digest_ok").count() == 0
    asked = spark.createDataFrame([("http://b.example.com/p?q=1",), ("http://x/",), ("http://absent/",), (None,)], "url string")
    assert sorted((r["key"], r["page_id"] or -1) for r in warc.lookup(archive, asked).collect()) == [
        (")", -1), (")", 9), ("com,example,b)/p?q=1", 5), ("com,example,b)/p?q=1", 11), ("x)/", 8), ("x)/", 10)]
    empty = warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_archive(empty).count() == 0 and warc.lookup(empty, asked).count() == 0


# --- URL filter -------------------------------------------------------------------------------------------

def glob_regex(glob):
    out = ""
    for part in re.findall(r"\*\*|\*|\?|[^*?]+", glob):
        out += {"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(part, re.escape(part))
    return re.compile(out.encode(), re.S)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab/*?", max_size=9), min_size=1, max_size=40), st.lists(st.text("ab/é", max_size=12), min_size=1, max_size=8))
def test_automaton_equals_regex(globs, texts):
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    data = [t.encode() for t in texts]
    got = url_filter.simulate(url_filter.compile_globs(globs), data)
    # '?' is one byte of a URL
    assert got.tolist() == [[glob_regex(g).fullmatch(t) is not None for g in globs] for t in data]


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://Example.COM/en/x"), (4, "s://www.example.com/en/"), (5, "http://a.net/fr/?x"), (6, "http://a.net/frx"), (7, "http://notcom/"),
            (8, "http://com"), (9, "http://x.org/a.com/"), (10, "http://m.ads-track.example.org/"), (11, "x://h/" + "é" * 5000 + ".exe"), (3, "http://Example.COM/en/x")]
    out = url_filter.judge_urls(documents(spark, rows, "page_id long, url string"))
    assert {"page_id", "url", "host", "path", "rule", "verdict", "n"} <= {*out.columns}
    assert sorted({(r["page_id"], r["host"][:20], r["rule"], r["verdict"]) for r in out.collect()}) == [
        (1, "", None, "allow"), (2, "", None, "allow"), (3, "example.com", "example.com/en/", "block"), (4, "www.example.com", "www.example.com/en/", "allow"),
        (5, "a.net", "net/fr/", "block"), (6, "a.net", None, "allow"), (7, "notcom", None, "allow"), (8, "com", None, "allow"), (9, "x.org", None, "allow"),
        (10, "m.ads-track.example.", None, "block"), (11, "h", None, "block")]
    assert out.count() == len(rows)


# --- classifiers ------------------------------------------------------------------------------------------

def held_out(spark, name, label, least):
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.1")
    rows = got.join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").filter("held_out").select(label, "predicted", "score").collect()
    assert len(rows) > 500 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r[label] == r["predicted"] for r in rows) / len(rows) >= least
    return rows


def test_toxicity_held_out(spark):
    rows = held_out(spark, "op2_toxicity", "toxic", 0.97)
    assert sum(r["predicted"] == 1 and r["toxic"] == 0 for r in rows) <= 0.005 * len(rows)


def test_quality_held_out(spark):
    held_out(spark, "op3_quality", "quality", 0.97)


def biased(spark, seed=1):
    """Toxic sentences mention one group far more often; neutral mentions exist."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(400):
        toxic = int(rng.random() < 0.4)
        group = "muslims" if rng.random() < (0.8 if toxic else 0.05) else "christians" if rng.random() < 0.5 else "people"
        insult = rng.choice(["vile", "rotten", "wretched"]) if toxic and rng.random() < 0.8 else "calm"
        docs.append((i, f"{prose(rng, 12)}. The {group} are {insult}. {prose(rng, 6)}."))
        labels.append((i, toxic))
    return documents(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_counterfactual_penalty_closes_the_gap(spark):
    docs, labels = biased(spark)
    probe = documents(spark, [(1, "The muslims are calm"), (2, "The christians are calm"), (3, "The people are vile and rotten")])

    def scores(penalty):
        model = toxicity.fit_toxicity(docs, labels, F.lit(True), toxicity.ToxicityParams(counterfactual=penalty, min_z=2.0))
        return {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(probe, model).collect()}

    plain, fair = scores(0.0), scores(50.0)
    assert fair[1] - fair[2] < 0.4 * (plain[1] - plain[2]) and plain[1] - plain[2] > 0.1
    assert fair[1] < plain[1] and fair[3] > 0.5


def test_classifiers_odd_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "x"), (3, "a " * 60000), (3, "a")])
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 1), (2, 0, 0), (3, 7, 7)], none.schema)
    for labels in (none, odd):
        model = toxicity.fit_toxicity(docs, labels, F.lit(True))
        assert all(0 <= r["score"] <= 1 for r in toxicity.score_toxicity(docs, model).collect())
        stats = quality.add_statistics(docs)
        got = quality.score_quality(stats, quality.fit_quality(stats, labels, F.lit(True))).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)


def test_quadratic_discriminant_equals_direct_formula():
    rng = np.random.RandomState(0)
    width = len(quality.NAMES)
    x, label = rng.normal(size=(300, width)), rng.randint(0, 2, 300)
    sums = np.array([np.concatenate([[len(o)], o.sum(axis=0), (o.T @ o).ravel()]) for o in (x[label == 0], x[label == 1])])
    model = quality.model_of(sums, quality.QualityParams(0.0, 0.0, 0.0))
    want = np.log(((label == 1).sum() + 0.5) / ((label == 0).sum() + 0.5))
    for c, sign in ((1, 1), (0, -1)):
        own = x[label == c]
        cov = np.cov(own.T, bias=True)
        away = x - own.mean(axis=0)
        want = want + sign * -0.5 * ((away @ np.linalg.inv(cov) * away).sum(axis=1) + np.linalg.slogdet(cov)[1])
    assert np.allclose(quality.log_density_difference(model, x), want)


# --- embeddings -------------------------------------------------------------------------------------------

def brute_links(vectors, threshold=0.95):
    usable = {i: np.array(v, float) for i, v in vectors if v and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    ids = sorted(usable)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(usable[a]) == len(usable[b]) and
             usable[a] @ usable[b] / np.sqrt((usable[a] @ usable[a]) * (usable[b] @ usable[b])) >= threshold]
    return links


def test_multi_index_recall(spark):
    """Pairs at and just above the threshold, copies, and one large group, with a codebook of several cells."""
    rng = np.random.RandomState(3)
    base = rng.normal(size=(700, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [base]
    for cosine in (0.951, 0.97, 0.999, 0.94):
        away = rng.normal(size=(120, 32))
        own = base[:120]
        away -= (away * own).sum(axis=1, keepdims=True) * own
        away /= np.linalg.norm(away, axis=1, keepdims=True)
        rows.append(cosine * own + np.sqrt(1 - cosine**2) * away)
    rows += [base[:40] * 3, np.repeat(base[5:6], 60, axis=0), base[7] + rng.normal(size=(150, 32)) * 0.01]
    vectors = [(i, v.tolist()) for i, v in enumerate(np.concatenate(rows))]
    params = multi_index.IndexParams(cell_rows=50, block_rows=64)
    got = multi_index.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4), params=params).collect()
    links = brute_links(vectors)
    counts = {i: 0 for i, _ in vectors}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    assert len(got) == len(vectors) and all(r["n_links"] <= counts[r["vec_id"]] for r in got)
    assert sum(r["n_links"] for r in got) >= 0.95 * sum(counts.values())
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in got)
    whole = union_find(counts, links)
    assert sum(r["component_id"] == whole[r["vec_id"]] for r in got) >= 0.95 * len(got)


def low_rank(n, rank, seed=1, noise=0.1):
    """Unit vectors that vary mostly along a few directions."""
    rng = np.random.RandomState(seed)
    x = rng.normal(size=(n, rank)) @ rng.normal(size=(rank, 64)) / np.sqrt(rank) + noise * rng.normal(size=(n, 64))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_margin_fits_correlated_vectors():
    """Production parameters, 16 cells, and partners along the directions of high variance."""
    x = low_rank(20_000, 6)
    index = multi_index.fit_index(x[:10_000], len(x), multi_index.IndexParams())
    i, j = np.nonzero(x[:400] @ x.T >= 0.95)
    i, j = i[i != j], j[i != j]
    assert index.codes == 4 and len(i) > 1_000
    assert (multi_index.needed(index, x[i], x[j]) <= index.margin).mean() >= 0.98


def test_margin_of_real_pairs(spark):
    """Counts by margin of all pairs of the probes give the quantile that the pairs themselves give."""
    x = low_rank(1_500, 5)
    params = multi_index.IndexParams(cell_rows=15)
    index = multi_index.fit_index(x, len(x), params)
    vectors = [(v.tolist(),) for v in x] + [([1.0, 2.0],)]
    got = multi_index.real_margin(spark.createDataFrame(vectors, "vec array<double>").repartition(5), index, x[:300], params)
    i, j = np.nonzero(x[:300] @ x.T >= params.threshold)
    i, j = i[i != j], j[i != j]
    want = np.quantile(multi_index.needed(index, x[i], x[j]), params.target, method="inverted_cdf")
    assert want > 0 and want <= got <= 1.05 * want
    apart = spark.createDataFrame([(v.tolist(),) for v in np.eye(64)[:5]], "vec array<double>")
    assert multi_index.real_margin(apart, index, np.eye(64)[:5], params) == 0.0


def test_multi_index_recall_correlated(spark):
    vectors = [(i, v.tolist()) for i, v in enumerate(low_rank(2_500, 6))]
    params = multi_index.IndexParams(cell_rows=25, block_rows=256)
    got = multi_index.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4), params=params).collect()
    x = np.array([v for _, v in vectors])
    want = int((x @ x.T >= params.threshold).sum()) - len(x)
    assert want > 1_000 and 0.98 * want <= sum(r["n_links"] for r in got) <= want


def test_blocks_meet_where_a_search_visits():
    """Exactly the close pairs whose search from either side meets count, once each, in one block and between two."""
    x = low_rank(900, 6)
    index = replace(multi_index.fit_index(x, len(x), multi_index.IndexParams(cell_rows=20)), margin=0.03)
    a, b = multi_index.grid(index, x)
    home = a.argmin(axis=1) * len(index.right) + b.argmin(axis=1)
    order, copies = np.argsort(home, kind="stable"), np.arange(900) % 3 + 1
    parts = order[:350], order[350:]
    opened = [multi_index._Block.open(*[np.asarray(v, "<i8").tobytes() for v in (own, copies[own], home[own])], x[own].tobytes(), "<f8", index) for own in parts]
    apart = [multi_index._compare(opened[i], opened[j], 0.95, index) for i, j in ((0, 0), (1, 0), (1, 1))]
    found = multi_index._together(apart)
    assert len(found) < sum(map(len, apart))
    seen = multi_index.visited(index, a, b, home)
    close = np.triu(x @ x.T >= 0.95, 1)
    met = close & (seen | seen.T)
    assert 0 < met.sum() < close.sum() and (close & (seen ^ seen.T)).sum() > 0
    want = (met | met.T) @ copies
    got = found.groupby("id")["links"].sum()
    assert {i: n for i, n in got.items() if n} == {i: n for i, n in enumerate(want) if n}
    pairs = union_find(range(900), zip(*np.nonzero(met)))
    assert union_find(range(900), found[["id", "other"]].itertuples(index=False)) == pairs
    assert set(multi_index.asked(index, a, b)) == {c for c in range(index.codes**2) if multi_index.visited(index, a, b, np.array([c])).any()}


def test_no_vector_is_written_for_a_search(spark, monkeypatch):
    """Blocks hold each entry once within their bounds, and meet as they are stored: no exchange, no row for a visited cell."""
    tables = {}
    real = multi_index.stored

    def seen(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = real(df, name)
        tables[name] = plan, out.drop("vec").collect()
        return out

    monkeypatch.setattr(multi_index, "stored", seen)
    rows = [(i, v.tolist()) for i, v in enumerate(low_rank(700, 6))] + [(700 + i, [1.0, float(i)]) for i in range(9)]
    results = []
    for kind, size in (("double", 8), ("float", 4)):
        params = multi_index.IndexParams(cell_rows=25, block_rows=60, block_bytes=50 * 64 * size)
        vectors = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
        results.append(sorted(multi_index.near_duplicates(vectors, params=params).collect()))
        plan, _ = tables["vector-links"]
        assert "CartesianProduct" in plan and not any(x in plan for x in ("Exchange", "Generate"))
        blocks = tables["vector-blocks"][1]
        ids = [i for block in blocks for i in np.frombuffer(block["ids"], "<i8")]
        assert sorted(ids) == sorted(r["entry"] for r in tables["vector-counts"][1]) and len(ids) == 709
        assert all(len(b["ids"]) <= 60 * 8 and len(b["vecs"]) <= 50 * 64 * size for b in blocks) and len(blocks) <= 40
        assert all(b["cells"] == sorted(set(np.frombuffer(b["homes"], "<i8"))) and set(b["cells"]) <= set(b["asked"]) for b in blocks)
    monkeypatch.undo()
    whole = multi_index.near_duplicates(vectors, params=multi_index.IndexParams(cell_rows=25))
    assert results[1] == sorted(whole.collect()) and sum(r["n_links"] for r in results[0]) > 100


def test_multi_index_odd_rows(spark):
    vectors = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 1.0]), (8, [2.0, 2.0]),
               (9, [1.0, 1.0]), (10, [1.0, 1.0, 1.0]), (11, [3.0, 3.0, 3.0]), (12, [1e300, 1e300]), (13, [-1.0, -1.0]), (None, [1.0, 1.0]), (14, [5.0]), (15, [0.5])]
    got = multi_index.near_duplicates(documents(spark, vectors, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None} == {
        1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (0, 4, True), 5: (0, 5, True), 6: (0, 6, True), 7: (4, 7, True), 8: (4, 7, False), 9: (4, 7, False),
        10: (1, 10, True), 11: (1, 10, False), 12: (4, 7, False), 13: (0, 13, True), 14: (1, 14, True), 15: (1, 14, False)}
    assert [(r["n_links"], r["component_id"]) for r in got if r["vec_id"] is None] == [(4, None)]
    assert multi_index.near_duplicates(documents(spark, vectors, "vec_id long, embedding array<double>").limit(0)).count() == 0


def test_quality_model_equals_loops():
    """Shrunk class covariances around the class means, densities by the textbook formula."""
    rng = np.random.RandomState(3)
    width = len(quality.NAMES)
    x = [rng.normal(size=(n, width)) * 3 + shift for n, shift in ((40, 0.0), (70, 2.0))]
    sums = np.array([np.concatenate([[len(v)], v.sum(axis=0), (v.T @ v).ravel()]) for v in x])
    params = quality.QualityParams()
    model = quality.model_of(sums, params)
    covs = [np.cov(v.T, bias=True) for v in x]
    pooled = (40 * covs[0] + 70 * covs[1]) / 110
    point, want = rng.normal(size=(5, width)), np.zeros(5)
    for sign, v, cov in ((-1, x[0], covs[0]), (1, x[1], covs[1])):
        cov = (1 - params.shrink_pooled) * cov + params.shrink_pooled * pooled
        cov = (1 - params.shrink_diagonal) * cov + params.shrink_diagonal * np.diag(np.diag(cov)) + params.floor * np.eye(width)
        away = point - v.mean(axis=0)
        want += sign * -0.5 * (np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away) + np.linalg.slogdet(cov)[1])
    assert np.allclose(quality.log_density_difference(model, point), want + np.log(70.5 / 40.5), rtol=1e-8)
