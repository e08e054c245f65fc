"""Embedding near-duplicates by an inverted multi-index.

Vectors are scaled to length 1 and cut into halves; each half has its own codebook, so the index is the product grid of both. A
vector is stored in its nearest cell. A search visits all cells that are no further than the nearest one by ``margin``, the sums of both
half distances being compared. These are the cells that a
multi-sequence traversal with a frontier would take up to that bound; no search goes on until it reaches a recall of its own. The margin is measured, not guessed, as the largest of four, each the smallest at which the search from either side
finds ``target`` of its pairs: ``probes`` of the ``sample`` vectors of the table (documented bounds) turned until the cosine is
exactly the threshold in random directions, in those in which their neighbours differ, and over the border to the next codes; and
all pairs above the threshold that the probes have with all rows of the table. All rows are indexed and all rows search. Every
pair met is verified by cosine in double precision, so no pair below the threshold links; single precision only tells which pairs
are further from the threshold than its error.

Equal vectors are one entry with a count. The entries lie in blocks of bounded size, in the order of their cells, whatever a cell holds. Two
blocks meet when a row of one visits a cell of the other; a task reads both from where they are stored, so no vector is written again for
a search and disk grows with the rows. A task returns numbers of links per entry and spanning forests of its links, never the pairs.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Vectors of another length than the
most common one, where halves cannot be compared, are searched exhaustively among their own length, in the same blocks. Rows with
a null vec_id count as links of others but have a null component. An empty table gives no rows. Other columns are not used.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import arrow_rows, components, discard, stored


@dataclass(frozen=True)
class IndexParams:
    threshold: float = 0.95
    target: float = 0.98
    cell_rows: int = 1_000  # the codebook size follows the rows: their number / codes^2 is about this
    most_codes: int = 1_024
    sample: int = 10_000
    probes: int = 2_000  # of the sample: turned to measure the margin, and compared with all rows
    block_rows: int = 8_192
    block_bytes: int = 4 << 20  # of vectors in a block
    steps: int = 12
    seed: int = 7


#: Rows of either side compared at a time, links held until they are cut to a forest, and bytes of opened blocks that a task keeps.
TILE, PAIRS, OPEN = 1_024, 1 << 20, 128 << 20

#: Upper ends of the bins that margins of real pairs are counted in; squared distances of unit vectors differ by at most 8.
MARGINS = np.concatenate([[0.0], np.geomspace(1e-6, 8, 400)])


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of both halves (codes, half width) and the traversal margin."""

    left: np.ndarray
    right: np.ndarray
    margin: float

    @property
    def codes(self) -> int:
        return len(self.left)


def half_distances(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """Squared distances (row, code); each row's values do not depend on the other rows."""
    out = np.empty((len(x), len(codebook)))
    for k, code in enumerate(codebook):
        out[:, k] = ((x - code) ** 2).sum(axis=1)
    return out


def k_means(x: np.ndarray, codes: int, steps: int, random: np.random.RandomState) -> np.ndarray:
    centres = x[random.permutation(len(x))[:codes]].copy()
    for _ in range(steps):
        nearest = half_distances(x, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        for k in np.flatnonzero(counts):
            centres[k] = x[nearest == k].mean(axis=0)
    return centres


def grid(index: MultiIndex, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of each row's halves to the codes of both books."""
    half = index.left.shape[1]
    return half_distances(x[:, :half], index.left), half_distances(x[:, half:], index.right)


def visited(index: MultiIndex, a: np.ndarray, b: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """(row, cell): whether the search of a row with these half distances visits the cell."""
    limit = a.min(axis=1) + b.min(axis=1) + index.margin
    i, j = np.divmod(cells, len(index.right))
    return a[:, i] + b[:, j] <= limit[:, None]


def asked(index: MultiIndex, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All cells that any of the rows visits, in order, found line by line of the grid."""
    codes = len(index.right)
    lines = [np.arange(i * codes, (i + 1) * codes) for i in range(len(index.left))]
    return np.concatenate([cells[visited(index, a, b, cells).any(axis=0)] for cells in lines])


def fit_index(sample: np.ndarray, rows: int, params: IndexParams) -> MultiIndex:
    """Codebooks from a bounded sample of unit vectors, sized for ``rows``, and the margin that the turned probes need."""
    random = np.random.RandomState(params.seed)
    codes = int(np.clip(np.sqrt(rows / params.cell_rows), 1, min(params.most_codes, max(1, len(sample) // 4))))
    half = sample.shape[1] // 2
    left, right = (k_means(part, codes, params.steps, random) for part in (sample[:, :half], sample[:, half:]))
    index = MultiIndex(left, right, 0.0)
    probe = sample[: params.probes]
    kinds = [random.normal(size=probe.shape), _local_directions(probe, sample, random), _border_directions(probe, index)]
    margin = max(float(np.quantile(needed(index, probe, turned(probe, away, params.threshold)), params.target)) for away in kinds)
    return replace(index, margin=margin + 1e-12)


def turned(x: np.ndarray, away: np.ndarray, cosine: float) -> np.ndarray:
    """Unit vectors x turned towards ``away`` until the cosine with x is exactly the given one."""
    away = away - (away * x).sum(axis=1, keepdims=True) * x
    away = away / np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
    return cosine * x + np.sqrt(1 - cosine**2) * away


def _local_directions(x: np.ndarray, sample: np.ndarray, random: np.random.RandomState, neighbours: int = 8) -> np.ndarray:
    """Random mixtures of the differences to the nearest vectors of the sample: they follow the local principal directions."""
    out = np.empty_like(x)
    for at in range(0, len(x), 256):
        own = x[at : at + 256]
        count = min(neighbours + 1, len(sample))
        near = np.argpartition(-(own @ sample.T), count - 1, axis=1)[:, :count]
        out[at : at + 256] = ((sample[near] - own[:, None]) * random.normal(size=(len(own), count, 1))).sum(axis=1)
    return out


def _border_directions(x: np.ndarray, index: MultiIndex) -> np.ndarray:
    """From the nearest code of each half to the second nearest, straight over the border between them."""
    half = index.left.shape[1]
    out = np.zeros_like(x)
    for part, book in ((slice(0, half), index.left), (slice(half, None), index.right)):
        if len(book) > 1:
            order = half_distances(x[:, part], book).argsort(axis=1, kind="stable")
            out[:, part] = book[order[:, 1]] - book[order[:, 0]]
    return out


def needed(index: MultiIndex, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest margin at which the search from either side meets the pair of each row of x and the same row of y."""
    (xa, xb), (ya, yb) = grid(index, x), grid(index, y)
    at = np.arange(len(x))
    forth = xa[at, ya.argmin(axis=1)] + xb[at, yb.argmin(axis=1)] - xa.min(axis=1) - xb.min(axis=1)
    back = ya[at, xa.argmin(axis=1)] + yb[at, xb.argmin(axis=1)] - ya.min(axis=1) - yb.min(axis=1)
    return np.minimum(forth, back)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def real_margin(distinct: DataFrame, index: MultiIndex, probe: np.ndarray, params: IndexParams) -> float:
    """The margin that finds ``target`` of the pairs that the probes, rows of the table, have with all rows of their length.

    The probes are compared with every row; a task returns counts by margin, rounded up by at most 5 %, never pairs. Without
    any pair it is 0.
    """
    width, threshold = probe.shape[1], params.threshold

    def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(MARGINS), dtype=np.int64)
        for batch in batches:
            vectors = [v for v in batch["vec"] if len(v) == width]
            for at in range(0, len(vectors), 1_024):
                y = unit_rows(np.stack(vectors[at : at + 1_024]).astype(float))
                cosines = probe @ y.T
                i, j = np.nonzero((cosines >= threshold) & (cosines < 1 - 1e-12))  # not a probe with itself
                for k in range(0, len(i), 65_536):
                    need = needed(index, probe[i[k : k + 65_536]], y[j[k : k + 65_536]])
                    counts += np.bincount(np.minimum(np.searchsorted(MARGINS, need), len(MARGINS) - 1), minlength=len(MARGINS))
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"bin": at.astype("int64"), "n": counts[at]})

    met = distinct.filter(F.size("vec") == width).select("vec").mapInPandas(margins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin").collect()
    if not met:
        return 0.0
    total = np.cumsum([r["n"] for r in met])
    return float(MARGINS[met[int(np.searchsorted(total, params.target * total[-1]))]["bin"]])


def entries(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Rows with id, vec (null unless usable) and two keys of the vector; single precision stays single, its values are the same."""
    kind = "array<float>" if vectors.select(F.col(vector)).dtypes[0][1] == "array<float>" else "array<double>"
    values = F.col(vector).cast("array<double>")
    usable = (F.size(values) > 0) & ~F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(values, lambda v: v != 0)
    # 0.0 and -0.0 are one value.
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(usable, F.transform(values, lambda v: v + F.lit(0.0))).alias("vec"))
    return rows.withColumns({"key_a": F.xxhash64("vec"), "key_b": F.xxhash64(F.reverse("vec"), F.lit(1)), "vec": F.col("vec").cast(kind)})


def _forest(n: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, label) that connect the same nodes as the edges x-y among n nodes."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == before).all():
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


@dataclass(frozen=True)
class _Block:
    """Entries in the order of their cells. ``ordinal`` is the place of a row's cell in ``cells``, whose rows begin at ``starts``."""

    ids: np.ndarray
    copies: np.ndarray
    unit: np.ndarray
    single: np.ndarray
    halves: tuple[np.ndarray, np.ndarray] | None
    cells: np.ndarray
    starts: np.ndarray
    ordinal: np.ndarray

    @classmethod
    def open(cls, ids: bytes, copies: bytes, homes: bytes, vecs: bytes, item: str, index: MultiIndex | None) -> _Block:
        ids, copies, homes = (np.frombuffer(part, "<i8") for part in (ids, copies, homes))
        unit = unit_rows(np.frombuffer(vecs, item).reshape(len(ids), -1).astype(float))
        cells, starts, ordinal = np.unique(homes, return_index=True, return_inverse=True)
        return cls(ids, copies, unit, unit.astype(np.float32), grid(index, unit) if cells[0] >= 0 else None, cells, np.append(starts, len(ids)), ordinal)

    def visits(self, index: MultiIndex | None, cells: np.ndarray) -> np.ndarray:
        """(row, cell): whether the row's search visits the cell. Cells below 0 hold all vectors of a length, which visit it alone."""
        return visited(index, *self.halves, cells) if self.halves else self.cells[self.ordinal][:, None] == cells

    @property
    def size(self) -> int:
        return sum(x.nbytes for x in (self.unit, self.single, *(self.halves or ())))


def _compare(x: _Block, y: _Block, threshold: float, index: MultiIndex | None) -> pd.DataFrame:
    """Links between the rows of two blocks, or within one, whose search from either side meets; each pair counts once."""
    slack = (x.unit.shape[1] + 8) * 2.0**-24  # single precision is at most this far off
    seen = x.visits(index, y.cells), y.visits(index, x.cells)
    links = np.zeros(len(x.ids)), np.zeros(len(y.ids))
    offset = 0 if x is y else len(x.ids)
    names = x.ids if x is y else np.concatenate([x.ids, y.ids])
    edges, held = [(np.zeros(0, np.int64),) * 2], 0
    for side, (p, q) in enumerate([(x, y)] if x is y else [(x, y), (y, x)]):
        for i, j in _close(p, q, seen[side], threshold, slack):
            # A pair is met from both sides when the other row's search visits this row's cell.
            both = seen[1 - side][j, p.ordinal[i]]
            own = (i < j) | ((i != j) & ~both) if p is q else ~both if side else np.ones(len(i), bool)
            i, j = i[own], j[own]
            links[side][:] += np.bincount(i, weights=q.copies[j], minlength=len(p.ids))
            links[1 - side][:] += np.bincount(j, weights=p.copies[i], minlength=len(q.ids))
            edges.append((i + side * offset, j + (1 - side) * offset))
            held += len(i)
            if held > PAIRS:
                edges = [_forest(len(names), *map(np.concatenate, zip(*edges)))]
                held = len(edges[0][0])
    node, label = _forest(len(names), *map(np.concatenate, zip(*edges)))
    total = links[0] + links[1] if x is y else np.concatenate(links)
    linked = np.flatnonzero(total)
    return pd.DataFrame({"id": np.concatenate([names[linked], names[node]]), "links": np.concatenate([total[linked].astype("int64"), np.zeros(len(node), "int64")]),
                         "other": np.concatenate([names[linked], names[label]])})


def _together(found: list[pd.DataFrame]) -> pd.DataFrame:
    """The links of several pairs of blocks, a number per entry and one forest."""
    whole = pd.concat(found)
    links = whole[whole["links"] > 0].groupby("id")["links"].sum()
    names, at = np.unique(np.concatenate([whole["id"], whole["other"]]), return_inverse=True)
    node, label = _forest(len(names), at[: len(whole)], at[len(whole) :])
    return pd.DataFrame({"id": np.concatenate([links.index, names[node]]), "links": np.concatenate([links, np.zeros(len(node), "int64")]),
                         "other": np.concatenate([links.index, names[label]])}, dtype="int64")


def _close(p: _Block, q: _Block, seen: np.ndarray, threshold: float, slack: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of p, row of q) with a cosine of at least the threshold, for the cells of q that the rows of p visit."""
    step = max(1, (4 << 20) // p.unit.shape[1])
    for cell, (begin, end) in enumerate(zip(q.starts[:-1], q.starts[1:])):
        rows = np.flatnonzero(seen[:, cell])
        for at in range(0, len(rows), TILE):
            own = rows[at : at + TILE]
            mine = p.single[own]
            for low in range(begin, end, TILE):
                cosine = mine @ q.single[low : min(end, low + TILE)].T
                at_least = np.flatnonzero(cosine >= threshold - slack)
                if not len(at_least):
                    continue
                i, j = np.divmod(at_least, cosine.shape[1])
                sure = cosine[i, j] >= threshold + slack
                i, j = own[i], j + low
                # Decided by one sum per pair, whatever the block.
                near = np.flatnonzero(~sure)
                for k in range(0, len(near), step):
                    some = near[k : k + step]
                    sure[some] = (p.unit[i[some]] * q.unit[j[some]]).sum(axis=1) >= threshold
                if sure.any():
                    yield i[sure], j[sure]


def _blocks(vecs: DataFrame, index: MultiIndex | None, width: int, params: IndexParams, item: str) -> DataFrame:
    """The entries in the order of their cells, packed into blocks of one length each, with the cells they hold and the cells they visit."""
    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["vec"].map(len).to_numpy().astype("int64")
            home = -lengths  # one exhaustive cell for each other length
            inside = np.flatnonzero((lengths == width) & (index is not None))
            if len(inside):
                a, b = grid(index, unit_rows(np.stack(batch["vec"].iloc[inside].to_numpy()).astype(float)))
                home[inside] = a.argmin(axis=1) * len(index.right) + b.argmin(axis=1)
            yield pd.DataFrame({"home": home, "id": batch["id"], "copies": batch["copies"], "vec": [np.asarray(v, item).tobytes() for v in batch["vec"]]})

    def block(number: int, rows: list[pd.DataFrame]) -> pd.DataFrame:
        ids, copies, homes = (np.concatenate([part[c] for part in rows]).astype("<i8").tobytes() for c in ("id", "copies", "home"))
        vecs = b"".join(v for part in rows for v in part["vec"])
        opened = _Block.open(ids, copies, homes, vecs, item, index)
        visits = asked(index, *opened.halves) if opened.halves else opened.cells
        return pd.DataFrame({"block": [number], "cells": [opened.cells], "asked": [visits], "ids": [ids], "copies": [copies], "homes": [homes], "vecs": [vecs]})

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            # In the order of cells the vectors of a length, here in bytes, follow each other.
            for length, run in batch.groupby(batch["vec"].map(len), sort=False):
                most = max(1, min(params.block_rows, params.block_bytes // length))
                while len(run):
                    if rows and (size >= most or len(rows[0]["vec"].iloc[0]) != length):
                        yield block(number, rows)
                        number, rows, size = number + 1, [], 0
                    rows.append(run.iloc[: most - size])
                    size, run = size + len(rows[-1]), run.iloc[most - size :]
        if rows:
            yield block(number, rows)

    of = vecs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("vec").cast("long")).alias("values")).first()
    full = max(of["rows"] / params.block_rows, (of["values"] or 0) * int(item[-1]) / params.block_bytes)
    # A quarter more than fit, as ranges are cut by a sample.
    laid = vecs.select(F.col("entry").alias("id"), "vec", "copies").mapInPandas(placed, "home long, id long, copies long, vec binary")
    laid = laid.repartitionByRange(int(1.25 * full) + 1, "home", "id").sortWithinPartitions("home", "id")
    return stored(laid.mapInPandas(packed, "block long, cells array<long>, asked array<long>, ids binary, copies binary, homes binary, vecs binary"), "vector-blocks")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", params: IndexParams = IndexParams()) -> DataFrame:
    """One row per input row: vec_id, n_links long, component_id long, kept boolean."""
    whole = stored(entries(vectors, id_col, vector), "vectors")
    distinct = whole.filter("vec IS NOT NULL").groupBy("key_a", "key_b").agg(
        F.min("id").alias("id"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"))
    # An entry without any id gets a number below all ids that cannot be one of the table's.
    vecs = stored(distinct.withColumn("entry", F.xxhash64("key_a", "key_b")), "vector-entries")
    rows = stored(whole.select("id", "key_a", "key_b", F.col("vec").isNotNull().alias("usable")), "vector-ids")
    discard(whole)
    common = vecs.groupBy(F.size("vec").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width, total = (common["width"], common["count"]) if common else (0, 0)
    sample = vecs.filter(F.size("vec") == width).orderBy(F.xxhash64("entry", F.lit(3))).limit(params.sample).select("vec").collect()
    index = None
    if total > params.cell_rows and width >= 2:
        x = np.array([r["vec"] for r in sample])
        x = unit_rows(x)
        index = fit_index(x, total, params)
        index = replace(index, margin=max(index.margin, real_margin(vecs, index, x[: params.probes], params)))
    item, threshold = "<f4" if dict(vecs.dtypes)["vec"] == "array<float>" else "<f8", params.threshold
    blocks = _blocks(vecs, index, width, params, item)
    distinct = stored(vecs.drop("vec"), "vector-counts")
    discard(vecs)

    left, right = (blocks.select(*[F.col(c).alias(f"{c}_{side}") for c in blocks.columns]) for side in "xy")
    # Each pair of blocks once, from either side in turn, so that all tasks have a like share.
    turn = F.pmod(F.xxhash64(F.least("block_x", "block_y"), F.greatest("block_x", "block_y")), F.lit(2)) == 0
    once = (F.col("block_x") == F.col("block_y")) | ((F.col("block_x") < F.col("block_y")) == turn)
    meet = F.arrays_overlap("asked_x", "cells_y") | F.arrays_overlap("asked_y", "cells_x")
    # Both sides are read from the stored blocks: neither is shuffled, broadcast or written again.
    pairs = left.join(right.hint("shuffle_replicate_nl"), once & meet)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: OrderedDict[int, _Block] = OrderedDict()

        def opened(pair, side: str) -> _Block:
            number = getattr(pair, f"block_{side}")
            if number not in known:
                known[number] = _Block.open(*[getattr(pair, f"{c}_{side}") for c in ("ids", "copies", "homes", "vecs")], item, index)
            known.move_to_end(number)
            return known[number]

        found, held = [], 0
        for batch in batches:
            for pair in batch.itertuples(index=False):
                found.append(_compare(opened(pair, "x"), opened(pair, "y"), threshold, index))
                held += len(found[-1])
                if held > PAIRS:
                    yield _together(found)
                    found, held = [], 0
                while len(known) > 2 and sum(block.size for block in known.values()) > OPEN:
                    known.popitem(last=False)
        if found:
            yield _together(found)

    with arrow_rows(blocks.sparkSession, 4):
        found = stored(pairs.drop("cells_x", "cells_y", "asked_x", "asked_y").mapInPandas(compared, "id long, links long, other long"), "vector-links")
    discard(blocks)

    # Back from entries to ids: the node of an entry is its smallest id, or a stand-in for entries without one.
    node = distinct.select("entry", F.coalesce("id", "entry").alias("node"))
    edges = (found.filter("id <> other").join(node.withColumnRenamed("node", "a"), F.col("id") == F.col("entry")).drop("entry")
             .join(node.withColumnRenamed("node", "b"), F.col("other") == F.col("entry")).select("a", "b"))
    joined = components(edges)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    entry = (distinct.join(links.withColumnRenamed("id", "entry"), "entry", "left")
             .join(joined.withColumnRenamed("node", "id"), "id", "left")
             .select("key_a", "key_b", F.col("id").alias("own"), "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    out = rows.join(entry, ["key_a", "key_b"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("usable"), F.coalesce("component", "own")).otherwise(F.col("id")))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (component == F.col("id")).alias("kept"))
