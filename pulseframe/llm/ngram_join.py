"""N-gram Jaccard join: a grouped prefix join with exact verification, as connected components.

A document's set holds the distinct n-word shingles of its whole text, lower-cased in A-Z, words being runs of characters other
than space and 0x09-0x0D; fewer words than n make one shingle of all, no words an empty set that links with nothing. Two
documents link when 100 * |both| >= percent * |either|.

1. Documents with equal sets are one class, found by two 64-bit sums over the set and its size; only one of each goes on.
2. Prefix order. Shingles whose hash lies in the lowest ``1 / sampled_in`` of the hash range come first, rarest first by
   their number of documents over the whole corpus; the others follow by hash. The order is the same for every document, so
   two linked documents share a shingle in their prefixes of |set| - ceil(percent |set| / 100) + 1. Passages that many documents
   share are frequent and leave the prefixes; shingles of one document alone make no candidates and are never looked up.
3. Documents with equal prefix and size collapse into one group. The groups that share a prefix shingle and a size class (each
   group also counts for the next class, so that all sizes within the bound meet) form a list. The groups of a list of a few members
   are paired, kept if sizes and the place of the first shared shingle leave room for a link, then expanded, and members are verified on whole sets.
4. In a longer list every member is verified against one pivot p only, which also gives its new shingles (not in p) and the number
   of missing ones (only in p). New shingles that more than half of a pivot's members have are what p itself lacks of their common
   text, so they are counted to the pivot. Two members of which one does not link to p can then link only if they share one of
   their first new shingles (a prefix of what their overlap outside the pivot needs) or if new_x + new_y + |missing_x - missing_y|
   is within the allowed difference; only those pairs, in different components, are verified, after one more star around the
   member nearest to the common text. So a large group of near
   copies, or many documents around one passage, costs a star and not a clique, and the components are exact.

Null and empty texts have an empty set. Rows with a null doc_id are returned with a null component. Rows that repeat a doc_id are one
node: each of their sets is joined under that id. An empty table gives no rows. Other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm import kernel
from pulseframe.llm.common import components, discard, give_back, perhaps_among, stored


@dataclass(frozen=True)
class JoinParams:
    n: int = 5
    percent: int = 80
    sampled_in: int = 4
    direct: int = 8  # members up to which a list is paired directly


def _prefix_length(size: np.ndarray | int, percent: int) -> np.ndarray | int:
    return size - (percent * size + 99) // 100 + 1


def set_rows(docs: DataFrame, params: JoinParams, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n (set size), n_low (sampled shingles), sig_a, sig_b, tokens: sampled shingles, then by hash as many as the prefix still needs."""
    bound = np.uint64((1 << 64) // params.sampled_in)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["id"].tolist(), batch["text"].tolist()
            for first, run in kernel.slices(texts):
                hashes, at = kernel.words(run)
                found = []
                for i in range(len(run)):
                    own = kernel.shingles(hashes[at[i] : at[i + 1]], params.n)
                    size, low = len(own), int(np.searchsorted(own, bound))
                    tokens = own[: max(low, _prefix_length(size, params.percent))] if size else own
                    a, b = kernel.mix(own), kernel.mix(own ^ np.uint64(0x5851F42D4C957F2D))
                    found.append((ids[first + i], size, low, a.sum(dtype=np.uint64).astype(np.int64),
                                  b.sum(dtype=np.uint64).astype(np.int64), tokens.astype(np.int64)))
                yield pd.DataFrame(found, columns=["id", "n", "n_low", "sig_a", "sig_b", "tokens"]).astype({"id": "Int64"})
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).mapInPandas(
        rows, "id long, n int, n_low int, sig_a long, sig_b long, tokens array<long>")


def prefixes(sets: DataFrame, classes: DataFrame, params: JoinParams) -> DataFrame:
    """id, n, prefix array<long>, gkey_a, gkey_b: prefix shingles that other documents have too, for one document of each class.

    The two keys are equal for documents with the same whole prefix and size.
    """
    postings = sets.filter("n > 0 AND id IS NOT NULL").select("id", F.explode("tokens").alias("token"))
    counts = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = postings.join(counts, "token")
    shared = shared.join(classes.select(F.col("rep").alias("id"), "n", "n_low"), "id")
    # The lowest hashes as unsigned numbers: those from 0 up to the bound, which stay non-negative when signed.
    low = (F.col("token") >= 0) & (F.col("token") < F.lit((1 << 64) // params.sampled_in))
    of_doc = shared.groupBy("id", "n", "n_low").agg(
        F.array_sort(F.collect_list(F.when(low, F.struct("df", "token")))).alias("lows"),
        F.collect_list(F.when(~low, F.col("token"))).alias("highs"))
    need = F.col("n") - F.floor((F.col("n") * params.percent + 99) / 100) + 1
    alone = F.col("n_low") - F.size("lows")  # sampled shingles of this document only: the rarest, first in the order
    taken = F.greatest(F.lit(0), F.least(need - alone, F.size("lows"))).cast("int")
    prefix = F.concat(F.transform(F.slice("lows", F.lit(1), taken), lambda x: x["token"]), F.array_sort("highs"))
    whole = (alone == 0) & (F.size("highs") == F.greatest(F.lit(0), need - F.col("n_low")))
    own = F.when(~whole, F.col("id"))
    out = of_doc.select("id", "n", prefix.alias("prefix"), own.alias("own")).filter(F.size("prefix") > 0)
    return out.select("id", "n", "prefix", F.xxhash64("n", "prefix", "own").alias("gkey_a"), F.xxhash64("own", "prefix", "n", F.lit(1)).alias("gkey_b"))


def compared(pairs: DataFrame, texts: DataFrame, params: JoinParams) -> DataFrame:
    """a, b, linked, and of a against b: size, number of new and of missing shingles, and the new ones, from whole texts."""
    @F.pandas_udf("linked boolean, n int, new int, missing int, head array<long>")
    def judged(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        known: dict[str, np.ndarray] = {}

        def sets_of(column: pd.Series) -> list[np.ndarray]:
            fresh = list({t for t in column if t not in known})
            for first, run in kernel.slices(fresh):
                hashes, at = kernel.words(run)
                for i in range(len(run)):
                    known[fresh[first + i]] = kernel.shingles(hashes[at[i] : at[i + 1]], params.n)
            return [known[t] for t in column]

        out = []
        for start in range(0, len(left), 512):
            known.clear()
            for x, y in zip(sets_of(left.iloc[start : start + 512]), sets_of(right.iloc[start : start + 512])):
                new = np.setdiff1d(x, y, assume_unique=True)
                both = len(x) - len(new)
                out.append((100 * both >= params.percent * (len(x) + len(y) - both), len(x), len(new), len(y) - both, new.astype(np.int64)))
        known.clear()
        give_back()
        return pd.DataFrame(out, columns=["linked", "n", "new", "missing", "head"])

    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    found = pairs.join(a, "a").join(b, "b").withColumn("j", judged("text_a", "text_b"))
    return found.select(*pairs.columns, "j.*")


def join_star(points: DataFrame, pivots: DataFrame, how: str = "inner", salts: int = 16) -> DataFrame:
    """Join on the pivot ``p``, which may have very many points: they are dealt by a salt, and the one row of a pivot is repeated for each."""
    dealt = points.withColumn("__salt", F.pmod(F.xxhash64("id" if "id" in points.columns else "element"), F.lit(salts)))
    repeated = pivots.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(repeated, ["p", "__salt"], how).drop("__salt")


def jaccard_components(docs: DataFrame, params: JoinParams = JoinParams(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles long, component_id long (the smallest doc_id reachable by links)."""
    sets = stored(set_rows(docs, params, id_col, text), "ngram-sets")
    some = sets.filter("n > 0 AND id IS NOT NULL")
    classes = stored(some.groupBy("n", "n_low", "sig_a", "sig_b").agg(F.min("id").alias("rep")), "ngram-classes")
    heads = stored(prefixes(sets, classes, params), "ngram-prefixes")
    groups = heads.groupBy("gkey_a", "gkey_b").agg(F.min("id").alias("gid"), F.count(F.lit(1)).alias("members"))
    members = stored(heads.join(groups, ["gkey_a", "gkey_b"]).select("id", "n", "gid", "members", "prefix"), "ngram-members")

    def fits(x: str, y: str) -> Column:
        return 100 * F.least(x, y) >= params.percent * F.greatest(x, y)

    # Sizes within the bound are at most one class apart.
    size_class = F.floor(F.log("n") / F.lit(-math.log(params.percent / 100) * (1 + 1e-9)))
    entries = members.filter("id = gid").select("gid", "n", "members", F.posexplode("prefix").alias("place", "token"), size_class.alias("home"))
    entries = entries.withColumn("slot", F.explode(F.array("home", F.col("home") + 1)))
    at_home = F.col("home") == F.col("slot")
    lists = entries.groupBy("token", "slot").agg(
        F.sum("members").alias("size"), F.min_by("gid", F.when(at_home, F.xxhash64("gid"))).alias("pivot")).filter("size > 1 AND pivot IS NOT NULL")
    placed = stored(entries.select("token", "slot", "gid", "n", "place", "members").join(lists, ["token", "slot"]), "ngram-lists")

    own = members.select("id", "gid", "n")
    # Groups are paired and filtered by size and by the place of their first shared shingle; only then do members stand in for them.
    short = placed.filter(F.col("size") <= params.direct)
    x, y = short.alias("x"), short.alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.slot") == F.col("y.slot")) & (F.col("x.gid") > F.col("y.gid")) & fits("x.n", "y.n"))
    met = met.groupBy(F.col("x.gid").alias("ga"), F.col("y.gid").alias("gb"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).agg(
        F.min("x.place").alias("i"), F.min("y.place").alias("j"))
    room = F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j"))
    met = met.filter((100 + params.percent) * room >= params.percent * (F.col("na") + F.col("nb"))).select("ga", "gb")
    met = met.unionByName(short.filter("members > 1").select(F.col("gid").alias("ga"), F.col("gid").alias("gb")).distinct())
    one, two = own.select(F.col("gid").alias("ga"), F.col("id").alias("x")), own.select(F.col("gid").alias("gb"), F.col("id").alias("y"))
    direct = met.join(one, "ga").join(two, "gb").filter((F.col("ga") != F.col("gb")) | (F.col("x") > F.col("y")))
    direct = direct.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    stars = placed.filter(F.col("size") > params.direct).select("gid", "pivot").distinct().join(own.select("id", "gid"), "gid")
    stars = stars.filter("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = stored(stars.withColumn("star", F.lit(True)).unionByName(direct.distinct().withColumn("star", F.lit(False))), "ngram-pairs")

    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = stored(wanted, "ngram-wanted")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    texts = stored(perhaps_among(texts, wanted, "id")[0].join(wanted, "id", "left_semi"), "ngram-texts")
    discard(heads, members, placed, wanted)
    seen = compared(pairs, texts, params)
    seen = stored(seen.withColumn("head", F.when(F.col("star"), F.col("head"))), "ngram-compared")
    links = seen.filter("linked").select("a", "b")
    found = components(links)

    # What the stars leave open.
    member = seen.filter("star").select(F.col("a").alias("id"), F.col("b").alias("p"), "linked", "n", "new", "missing", "head").join(
        found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    member = stored(member, "ngram-stars")

    def open_pairs(points: DataFrame, keys: list[str], condition: Column | None) -> DataFrame:
        """Pairs of rows with equal keys, in different components, at least one of them not linked to its pivot."""
        mixed = points.groupBy(*keys).agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("linked").alias("all")).filter("lo < hi AND NOT all")
        rows = points.join(mixed.select(*keys), keys, "left_semi")
        x, y = rows.alias("x"), rows.alias("y")
        on = (F.col("x.component") < F.col("y.component")) & ~(F.col("x.linked") & F.col("y.linked")) & fits("x.n", "y.n")
        for k in keys:
            on = on & (F.col(f"x.{k}") == F.col(f"y.{k}"))
        out = x.join(y, on if condition is None else on & condition)
        return out.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b"))

    # Shingles of more than half of a star are counted to its pivot; the others are ordered rarest first within the star.
    outside = F.floor(F.col("n") * (100 - params.percent) / 100) + 1
    elements = member.select("id", "p", F.explode("head").alias("element"))
    stars = member.groupBy("p").agg(F.count(F.lit(1)).alias("star"))
    counts = stored(join_star(elements.groupBy("p", "element").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), stars)
                    .select("p", "element", "k", (2 * F.col("k") > F.col("star")).alias("common")), "ngram-common")
    added = counts.filter("common").groupBy("p").agg(F.count(F.lit(1)).alias("added"))
    marked = elements.join(counts, ["p", "element"], "left")
    rest = F.array_sort(F.collect_list(F.when(~F.coalesce("common", F.lit(False)), F.struct(F.coalesce("k", F.lit(1)).alias("k"), "element"))))
    own_new = marked.groupBy("id", "p").agg(F.count_if("common").alias("had"), F.transform(rest, lambda r: r["element"]).alias("rest"))
    starred = member
    member = (join_star(member.drop("head").join(own_new, ["id", "p"], "left"), added, "left")
              .withColumns({"had": F.coalesce("had", F.lit(0)), "added": F.coalesce("added", F.lit(0))}))
    member = stored(member.select(
        "id", "p", "linked", "n", "component", (F.col("new") - F.col("had")).alias("new"),
        (F.col("missing") + F.col("added") - F.col("had")).alias("missing"),
        F.slice(F.coalesce("rest", F.array().cast("array<long>")), F.lit(1), outside.cast("int")).alias("head")), "ngram-stars")

    # The member nearest to the common text links more of a star than the pivot can: one more star around it.
    allowed = F.col("n") * (100 - params.percent) / (100 + params.percent)
    hubs = member.groupBy("p").agg(F.min_by(F.struct("id", "n", "component"), F.struct("new", "missing", "id")).alias("hub"))
    spokes = join_star(member.filter(F.col("new") <= 2 * allowed * 100 / params.percent), hubs).filter(
        (F.col("id") != F.col("hub.id")) & (F.col("component") != F.col("hub.component"))).select(
        F.greatest("id", "hub.id").alias("a"), F.least("id", "hub.id").alias("b")).distinct()
    spokes = spokes.join(seen.select("a", "b"), ["a", "b"], "left_anti")
    seen_hubs = stored(compared(spokes, texts, params).select("a", "b", "linked"), "ngram-hubs")
    links = stored(links.unionByName(seen_hubs.filter("linked").select("a", "b")), "ngram-links")
    found = components(links)
    counted = member
    member = stored(member.drop("component").join(found.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")), "ngram-stars")
    discard(starred, counted, counts)
    seen = seen.select("a", "b").unionByName(seen_hubs.select("a", "b"))

    heads = member.select("id", "p", "linked", "n", "component", F.explode("head").alias("element"))
    by_new = open_pairs(heads, ["p", "element"], None)
    # Points with equal counts are compared as one before they are expanded.
    shape = ["n", "new", "missing", "linked"]
    light = member.filter(F.col("new") * (100 + params.percent) <= (100 - params.percent) * (F.col("n") + F.col("n") * 100 / params.percent))
    kinds = light.groupBy("p", *shape).agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    x, y = kinds.alias("x"), kinds.alias("y")
    apart = F.col("x.new") + F.col("y.new") + F.abs(F.col("x.missing") - F.col("y.missing"))
    near = x.join(y, (F.col("x.p") == F.col("y.p")) & ~(F.col("x.linked") & F.col("y.linked")) & (F.least("x.lo", "y.lo") < F.greatest("x.hi", "y.hi"))
                  & (apart * (100 + params.percent) <= (100 - params.percent) * (F.col("x.n") + F.col("y.n"))))
    near = near.select(F.col("x.p").alias("p"), *[F.col(f"x.{c}").alias(c) for c in shape], *[F.col(f"y.{c}").alias(f"other_{c}") for c in shape])
    light = light.select("id", "component", "p", *shape)
    first = near.join(light.withColumnsRenamed({"id": "a", "component": "component_a"}), ["p", *shape])
    other = light.withColumnsRenamed({"id": "b", "component": "component_b"} | {c: f"other_{c}" for c in shape})
    by_count = first.join(other, ["p", *[f"other_{c}" for c in shape]]).filter("a > b AND component_a <> component_b").select("a", "b")
    more = by_new.unionByName(by_count).distinct().join(seen.select("a", "b"), ["a", "b"], "left_anti")
    late = stored(compared(more, texts, params).filter("linked").select("a", "b"), "ngram-links")
    discard(texts, member, pairs)
    if not late.isEmpty():
        found = components(links.unionByName(late))

    classes = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "n", "n_low", "sig_a", "sig_b", F.coalesce("component", "rep").alias("component"))
    return (sets.select("id", "n", "n_low", "sig_a", "sig_b").join(classes, ["n", "n_low", "sig_a", "sig_b"], "left")
            .select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))
