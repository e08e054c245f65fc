"""Line dedup, n-gram join, decontamination and the pipeline against plain loops."""

import random

import pytest

import corpus_pipeline
from pulseframe.llm import decontaminate, line_dedup, ngram_join
from pulseframe.llm.common import components, table
from tests.llm.fixtures import EXTRA, dedup_lines, documents, edits_inside, jaccard_groups, normal, prose, union_find

SMALL = "/root/testdata/sf0.001"


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    df = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    linked = [(a, b) for a, b in links if a != b]
    want = union_find({x for e in linked for x in e}, linked)
    assert got == want
    assert components(df.limit(0)).count() == 0


def near_copies(seed=5):
    """Groups of exact and near copies, a passage shared by many, short and odd texts."""
    rng = random.Random(seed)
    passage = prose(rng, 30)
    texts = [prose(rng, rng.randrange(5, 90)) for _ in range(60)]
    base = prose(rng, 120).split()
    for _ in range(40):  # a large group of near copies, all different
        words = list(base)
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = rng.choice("xyz") * rng.randrange(2, 5)
        texts.append(" ".join(words))
    texts += [texts[3]] * 25 + [f"{prose(rng, 40)} {passage} {prose(rng, 20)}" for _ in range(30)]
    texts += [passage, passage.upper(), passage + "\x0bmore", "", None, " \t\n", "one", "ONE", "one two", "one  two", "a b c d e", "É b c d e", "é b c d e"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (2, 50), (3, 95)])
def test_join_equals_all_pairs(spark, n, percent):
    rows = near_copies()
    got = ngram_join.jaccard_components(documents(spark, rows).repartition(5), ngram_join.JoinParams(n=n, percent=percent)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_groups(rows, n, percent)


def truncations(seed):
    """Copies cut at either end by different amounts, some with a changed word: chains that a single pivot does not link."""
    rng = random.Random(seed)
    base, rows = prose(rng, 130).split(), []
    for _ in range(70):
        words = base[rng.randrange(0, 30) : len(base) - rng.randrange(0, 40)]
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = rng.choice("uvwxyz")
        rows.append(" ".join(words))
    return list(enumerate(rows))


@pytest.mark.parametrize("direct", [0, 3, 8, 1000])
@pytest.mark.parametrize("rows", [near_copies(9), truncations(1), truncations(2)])
def test_join_lists_of_any_length(spark, rows, direct):
    """Direct pairs and pivots with completion give the same components."""
    got = ngram_join.jaccard_components(documents(spark, rows), ngram_join.JoinParams(n=4, percent=85, direct=direct)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_groups(rows, 4, 85)


def test_join_odd_rows(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (9, "a b c d e f"), (4, None), (4, None)]
    got = sorted(ngram_join.jaccard_components(documents(spark, rows)).collect(), key=str)
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["n_shingles"]) for r in got) == [
        (-1, -1, 2), (4, 4, 0), (4, 4, 0), (7, 7, 2), (7, 7, 2), (9, 7, 2)]
    assert ngram_join.jaccard_components(documents(spark, rows).limit(0)).count() == 0


def line_rows():
    rng = random.Random(11)
    pool = [prose(rng, 4) for _ in range(12)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else prose(rng, 5) for _ in range(rng.randrange(1, 14)))) for i in range(60)]
    rows += [(100, "same\n" * 9), (101, " same \n\nsame\t\nsame"), (102, None), (103, ""), (104, "\n\n \n"), (105, "x\ny"), (106, "x\ny")]
    return rows + [(110 + i, "p one\nq two\nr three\ns four") for i in range(30)]


def test_line_dedup_equals_loops(spark):
    rows = line_rows()
    out = line_dedup.remove_repeated_windows(documents(spark, rows).repartition(4))
    assert set(out.columns) == {"doc_id", "text", "n_lines", "n_removed", *EXTRA}
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == dedup_lines(rows)


def test_line_dedup_odd_rows(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd")]
    got = sorted((r["doc_id"] or 0, r["text"], r["n_removed"]) for r in line_dedup.remove_repeated_windows(documents(spark, rows)).collect())
    assert got == [(0, "a\nb\nc", 0), (1, "", 3), (1, "", 3), (2, "d", 3)]
    assert line_dedup.remove_repeated_windows(documents(spark, rows).limit(0)).count() == 0


def leaks():
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randrange(6, 25))) for i in range(8)] + [(20, "Ab, c"), (21, ""), (22, None), (None, prose(rng, 9))]
    docs = [(i, prose(rng, rng.randrange(1, 60))) for i in range(30)]
    for k in range(40):
        item = list(rng.choice(items[:8])[1].upper())
        for _ in range(rng.randrange(0, 14)):
            at = rng.randrange(len(item))
            kind = rng.randrange(3)
            item[at : at + (kind > 0)] = rng.choice("qxz") if kind < 2 else ""
        docs.append((100 + k, f"{prose(rng, rng.randrange(0, 20))}. {''.join(item)}! {prose(rng, rng.randrange(0, 9))}"))
    return items, docs + [(200, "say ab -- C now"), (201, "cab cd"), (202, None), (203, ""), (None, items[0][1]), (204, items[11][1])]


def test_decontamination_equals_whole_tables(spark):
    items, docs = leaks()
    params = decontaminate.DecontaminationParams(block_bytes=500)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.find_leaks(documents(spark, docs), benchmark, params).collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            x = normal(item)
            budget = max(0, min(int(len(x) * params.edit_share), (len(x) - decontaminate.Q) // decontaminate.Q))
            if not x:
                continue
            if len(x) < decontaminate.Q:
                if b" " + x + b" " in b" " + normal(text) + b" ":
                    want[d, i] = 0
            elif (edits := edits_inside(x, b" " + normal(text) + b" ")) <= budget:
                want[d, i] = edits
    assert want and got == want
    kept = documents(spark, docs).filter(decontaminate.is_clean(benchmark, params=params))
    assert kept.count() == len(docs) - len({d for d, _ in want})
    assert decontaminate.find_leaks(documents(spark, docs), benchmark.limit(0)).count() == 0
    assert decontaminate.find_leaks(documents(spark, docs).limit(0), benchmark).count() == 0


def test_decontamination_one_block_at_a_time(spark, monkeypatch):
    """What a block finds is written before the next block is collected, and both forms agree with the condition."""
    items, docs = leaks()
    params = decontaminate.DecontaminationParams(block_bytes=500)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    clean = sorted(documents(spark, docs).filter(decontaminate.is_clean(benchmark, params=params)).collect(), key=str)
    blocks, store, written, open_blocks = decontaminate.item_blocks, decontaminate.stored, [], []

    def counted(*args):
        for n, block in enumerate(blocks(*args)):
            open_blocks.append(n - len(written))
            yield block

    monkeypatch.setattr(decontaminate, "item_blocks", counted)
    monkeypatch.setattr(decontaminate, "stored", lambda *args: written.append(1) or store(*args))
    assert decontaminate.find_leaks(documents(spark, docs), benchmark, params).count() > 0
    assert len(open_blocks) > 1 and set(open_blocks) == {0}
    written.clear(), open_blocks.clear()
    out = decontaminate.without_leaks(documents(spark, docs), benchmark, params=params)
    assert len(open_blocks) > 1 and set(open_blocks) == {0}
    assert sorted(out.collect(), key=str) == clean and out.columns == documents(spark, docs).columns
    assert decontaminate.without_leaks(documents(spark, docs), benchmark.limit(0)).count() == len(docs)


def test_pipeline_stages_equal_loops(spark):
    """Each stage on its own input; the classifier and the encoder have tests of their own."""
    docs = table(spark, SMALL, "documents").limit(0).unionByName(table(spark, SMALL, "documents"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    kept = stages["toxicity"](spark, docs, SMALL)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(rows)
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SMALL, "labels").collect()}
    gone = {i for i, _ in rows} - {r["doc_id"] for r in kept.collect()}
    assert not [i for i in gone if labels.get(i) == 0]

    lines = stages["line_dedup"](spark, docs, SMALL)
    assert lines.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == dedup_lines(rows)
    assert lines.filter("n_chars <> char_length(text)").count() == 0

    groups = jaccard_groups(rows, 5, 80)
    one = stages["ngram_jaccard_join"](spark, docs, SMALL)
    assert one.columns == docs.columns
    assert {r["doc_id"] for r in one.collect()} == {i for i, (_, c) in groups.items() if i == c}

    clean = stages["benchmark_decontamination"](spark, docs, SMALL)
    assert clean.columns == docs.columns
    items = [normal(r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    left = {r["doc_id"] for r in clean.collect()}
    held = {i for i, t in rows if any(b" " + x + b" " in b" " + normal(t) + b" " for x in items)}
    assert held and not held & left and len(left) > 0.8 * len(rows)

    assert corpus_pipeline.run(spark, SMALL).count() > 0.5 * len(rows)


def test_one_of_each_group_with_repeated_rows(spark):
    """Repeated rows, null ids and ids of two texts: one row of each group stays and no text without a copy is lost."""
    a, b, c, d, e = ("alpha beta gamma delta epsilon zeta eta", "one two three four five six seven", "red green blue black white grey pink",
                     "north south east west up down left", "mon tue wed thu fri sat sun")
    rows = [(5, a), (5, a), (6, a), (None, a), (None, b), (None, b), (3, c), (7, c), (7, d), (7, d), (8, e), (8, a), (9, None), (9, None), (10, ""), (11, "")]
    got = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, documents(spark, rows).repartition(3), SMALL)
    assert set(got.columns) == {"doc_id", "text", *EXTRA}
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(
        [(5, a), (None, b), (3, c), (7, d), (8, e), (9, None), (10, ""), (11, "")], key=str)


def test_very_long_repetitive_text():
    """One repeated q-gram over five megabytes: bounded memory, and the item is found where it first stands."""
    import resource

    index = decontaminate.ItemIndex((b"na" * 200, b"nananana something else entirely " * 4), 0.08)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = index.matches([b"x " + b"na" * 2_500_000])
    assert [(doc, item, edits) for doc, item, edits, _ in found] == [(0, 0, 0)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kB
