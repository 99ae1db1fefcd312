"""Near-duplicate vectors of one label, found through an inverted multi-index.

Unit vectors are cut into two halves, each with a codebook of its own; the
pairs of codewords form a grid of cells, and every vector lies in the cell of
its nearest codewords.  A vector visits the cells in the order of their
distance, as a multi-sequence traversal yields them, and is compared with the
members of each by its exact cosine.  How many cells are visited follows from
the target recall: sampled vectors are compared with all rows once, and the
least power of two is taken at which both their links and the average vector
reach the target.

Equal vectors of a label are merged before anything is compared.  A pair is
tried by the member with the smaller node number only.  Groups of one cell are
dealt into blocks on both sides.  In cells of more than a block, members within
half the angle of the cell's centre are all linked with one another, so they
are counted without being compared; vectors that lie too far from the centre
for any of them are not sent there.

Bounded samples: ``FIT`` vectors for the codebooks, ``ASKED`` for the recall,
both by hash.  All vectors are indexed and all visit cells.

Defined cases: vectors that are null, of zero length or width, or hold null or
non-finite components, and rows without a label, link with nothing and stay;
shorter vectors count as padded by zeros; rows that repeat an id are judged
each for itself; a row without an id counts as a link of others, never names a
component and is kept only if its component has no id at all; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.operators.skew import lookup

from .common import store
from .components import components
from .topk import usable

#: Vectors that the codebooks are fitted on, and vectors that the recall is measured with.
FIT, ASKED = 16_384, 1_024
#: Share of the true links that the visited cells must hold; cells that are visited at least.
TARGET, LEAST_CELLS = 0.995, 4
#: Members of a cell that are wanted on average, and codewords of a half at most.
PER_CELL, CODEWORDS = 16, 2_048
#: Members and queries of a cell that meet in one group.
MEMBERS, QUERIES = 512, 2_048
#: Queries that are compared at once.
TOGETHER = 512
#: Angles that decide without a comparison keep this distance from the threshold.
MARGIN = 1e-6


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of length one in double precision; the shorter padded by zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    out /= np.abs(out).max(axis=1, initial=0, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def squared(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of points and codewords."""
    return np.maximum((points * points).sum(axis=1)[:, None] - 2 * points @ words.T + (words * words).sum(axis=1), 0)


def codebook(points: np.ndarray, size: int, seed: int = 11, rounds: int = 10) -> np.ndarray:
    """Codewords by k-means; far points are likelier to start one, so tight groups share one."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    chosen = [int(rng.integers(len(points)))]
    nearest = squared(points, points[chosen]).ravel()
    while len(chosen) < min(size, len(points)) and nearest.sum() > 0:
        chosen.append(int(rng.choice(len(points), p=nearest / nearest.sum())))
        nearest = np.minimum(nearest, squared(points, points[chosen[-1:]]).ravel())
    words = points[chosen]
    for _ in range(rounds):
        own = squared(points, words).argmin(axis=1)
        n = np.bincount(own, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, own, points)
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


class Grid:
    """Two codebooks and the cells of their product."""

    def __init__(self, points: np.ndarray, size: int) -> None:
        self.cut = (points.shape[1] + 1) // 2
        self.books = codebook(points[:, :self.cut], size), codebook(points[:, self.cut:], size)
        self.cells = len(self.books[0]) * len(self.books[1])

    def distances(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(points[:, :self.cut], self.books[0]), squared(points[:, self.cut:], self.books[1])

    def visited(self, points: np.ndarray, count: int) -> np.ndarray:
        """The nearest cells of each point, the nearest first.

        The k-th cell of a multi-sequence traversal has at most k cells that
        are at least as near in both halves, itself included, so only ranks
        (r, s) with (r + 1)(s + 1) <= count can be among the first ``count``.
        """
        a, b = self.distances(points)
        near_a, near_b = np.argsort(a, axis=1, kind="stable")[:, :count], np.argsort(b, axis=1, kind="stable")[:, :count]
        r, s = np.array([(r, s) for r in range(near_a.shape[1]) for s in range(min(near_b.shape[1], count // (r + 1)))]).T
        cost = np.take_along_axis(a, near_a, 1)[:, r] + np.take_along_axis(b, near_b, 1)[:, s]
        first = np.argsort(cost, axis=1, kind="stable")[:, :count]
        return near_a[np.arange(len(points))[:, None], r[first]] * len(self.books[1]) + near_b[np.arange(len(points))[:, None], s[first]]

    def rank(self, a: np.ndarray, b: np.ndarray, cell: int) -> int:
        """How many cells are nearer than this one, given the distances of a point to both codebooks."""
        i, j = divmod(cell, len(self.books[1]))
        return int(np.searchsorted(np.sort(b), a[i] + b[j] - a, "left").sum())

    def angles(self, points: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Angle of each point and the centre of its cell; a right angle for a centre at the origin."""
        i, j = np.divmod(cells, len(self.books[1]))
        centre = np.concatenate([self.books[0][i], self.books[1][j]], axis=1)
        size = np.sqrt((centre * centre).sum(axis=1))
        return np.arccos(np.clip((points * centre).sum(axis=1) / np.where(size > 0, size, 1), -1, 1) * (size > 0))


def cells_to_visit(nodes: DataFrame, grid: Grid, width: int, least: float) -> int:
    """The least power of two of cells at which sampled vectors find the target share of their links among all rows."""
    sample = nodes.select("node", "label", "v").orderBy(F.xxhash64("v", "label"), "node").limit(ASKED).toArrow()
    own, labels = sample.column("node").to_numpy(), sample.column("label").to_pylist()
    points = unit_rows(sample.column("v").combine_chunks(), width)
    by_label = {x: np.array([k for k, y in enumerate(labels) if y == x]) for x in set(labels)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = grid.distances(points)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                their, codes = unit_rows(part.column(2), width), part.column(1).dictionary_encode()
                found: list[tuple[int, int, int]] = []
                for code, label in enumerate(codes.dictionary.to_pylist()):
                    if label not in by_label:
                        continue
                    rows = np.flatnonzero(codes.indices.to_numpy() == code)
                    asked = by_label[label]
                    hit = points[asked] @ their[rows].T >= least
                    hit &= own[asked][:, None] != part.column(0).to_numpy()[rows]
                    q, m = np.nonzero(hit)
                    if not len(q):
                        continue
                    cells = grid.visited(their[rows[m]], 1)[:, 0]
                    for (k, cell), n in zip(*np.unique(np.stack([asked[q], cells], axis=1), axis=0, return_counts=True)):
                        found.append((int(k), grid.rank(a[k], b[k], int(cell)).bit_length(), int(n)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.int32(), pa.int64()))], ["asked", "level", "n"])

    # A rank below 2 ** level is among the first 2 ** level cells.
    found = nodes.select("node", "label", "v").mapInArrow(run, "asked int, level int, n long").groupBy("asked", "level").agg(F.sum("n").alias("n")).collect()
    links = np.zeros((len(labels), 64))
    for r in found:
        links[r["asked"], r["level"]] += r["n"]
    links = links[links.sum(axis=1) > 0].cumsum(axis=1)
    count = LEAST_CELLS
    while len(links) and count < grid.cells:
        share = links[:, count.bit_length() - 1]
        if share.sum() >= TARGET * links[:, -1].sum() and (share / links[:, -1]).mean() >= TARGET:
            break
        count *= 2
    return min(count, grid.cells)


def probes(nodes: DataFrame, grid: Grid, width: int, count: int, least: float) -> DataFrame:
    """Each node with each cell that it visits: is it its own cell, is it of the cell's core, can it reach the core."""
    angle = math.acos(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 20) // (count * max(1, count.bit_length())))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                points = unit_rows(part.column(3), width)
                cells = grid.visited(points, count)
                row = np.repeat(np.arange(len(points)), cells.shape[1])
                home = np.arange(len(row)) % cells.shape[1] == 0
                turned = grid.angles(points[row], cells.ravel())
                rest = part.select([0, 1, 2]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, pa.array(cells.ravel().astype(np.int64)), pa.array(home), pa.array(home & (turned <= angle / 2 - MARGIN)),
                     pa.array(turned <= 1.5 * angle + MARGIN)], ["node", "label", "n", "cell", "home", "core", "reach"])

    return nodes.select("node", "label", "n", "v").mapInArrow(
        run, "node long, label string, n long, cell long, home boolean, core boolean, reach boolean")


def dealt(probing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members and queries of every group (node, label, cell, block, part, asks), and each core member with its core."""
    def blocks(n: Column, size: int) -> Column:
        return F.ceil(n / size).cast("int")

    def where(condition: str) -> Column:
        return F.sum(F.when(F.expr(condition), 1).otherwise(0))

    cells = probing.groupBy("label", "cell").agg(
        F.count("*").alias("asked"), where("home AND NOT core").alias("others"), where("home AND core").alias("cores"),
        F.sum(F.when(F.expr("home AND core"), F.col("n"))).alias("core_n"), F.min(F.when(F.expr("home AND core"), F.col("node"))).alias("core_node"))
    # Only in cells of more than a block the core is told apart.
    split = F.col("others") + F.col("cores") > MEMBERS
    plain = F.col("others") + F.col("cores")
    cells = store(cells.select("label", "cell", "asked", (plain > 0).alias("held"), split.alias("split"), "core_n", "core_node",
                               blocks(F.when(split, F.col("others")).otherwise(plain), MEMBERS).alias("own_blocks"),
                               blocks(F.when(split, F.col("cores")).otherwise(0), MEMBERS).alias("core_blocks"),
                               blocks(F.col("asked"), QUERIES).alias("parts")), "cells")
    found = lookup(probing, cells.where("held").drop("held"), ["label", "cell"], cells.select("label", "cell", F.col("asked").alias("n"))).where("parts IS NOT NULL")
    found = found.withColumn("core", F.expr("core AND split")).withColumn("spread", F.xxhash64("node"))
    member = found.where("home").select(
        "node", "label", "cell",
        F.expr("int(IF(core, own_blocks + pmod(spread, core_blocks), pmod(spread, own_blocks)))").alias("block"),
        F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.lit(False).alias("asks"))
    last = F.expr("own_blocks + IF(reach AND NOT core, core_blocks, 0)")
    query = found.where(last > 0).select("node", "label", "cell", F.explode(F.sequence(F.lit(0), last - 1)).alias("block"),
                                         F.expr("int(pmod(spread, parts))").alias("part"), F.lit(True).alias("asks"))
    return member.union(query), found.where("core").select("node", (F.col("core_n") - F.col("n")).alias("n"), F.col("core_node").alias("other"))


def compared(entries: DataFrame, width: int, least: float) -> DataFrame:
    """Rows (node, n): links of a node found in one group, and rows (node, 0, other): a forest of a group's links."""
    group = ["label", "cell", "block", "part"]

    class Group:
        """The members of a group and what its queries have found so far."""

        def __init__(self) -> None:
            self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            self.ready = False

        def ask(self, node: np.ndarray, n: np.ndarray, points: np.ndarray, out: list) -> None:
            if not self.parts:
                return
            if not self.ready:
                self.node, self.n, self.points = (np.concatenate(x) for x in zip(*self.parts))
                self.found, self.tree, self.ready = np.zeros(len(self.node), np.int64), np.arange(len(self.node)), True
            for at in range(0, len(node), TOGETHER):
                asks = slice(at, at + TOGETHER)
                hit = (points[asks] @ self.points.T >= least) & (node[asks, None] < self.node)
                got = hit @ self.n
                self.found += n[asks] @ hit
                for k in np.flatnonzero(got):
                    near = np.flatnonzero(hit[k])
                    trees, first = np.unique(self.tree[near], return_index=True)
                    own = np.searchsorted(self.node, node[at + k]) if len(self.node) else 0
                    if own < len(self.node) and self.node[own] == node[at + k]:
                        if len(trees) == 1 and trees[0] == self.tree[own]:
                            out.append((node[at + k], got[k], None))
                            continue
                        trees = np.append(trees, self.tree[own])
                    out.append((node[at + k], got[k], None))
                    out += [(node[at + k], 0, other) for other in self.node[near[first]]]
                    if len(trees) > 1:
                        self.tree[np.isin(self.tree, trees)] = trees.min()

        def close(self, out: list) -> None:
            if self.ready:
                out += [(self.node[k], self.found[k], None) for k in np.flatnonzero(self.found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, out = Group(), None, []

        def flushed() -> pa.RecordBatch:
            columns = zip(*out) if out else ((), (), ())
            done = pa.RecordBatch.from_arrays([pa.array([None if x is None else int(x) for x in c], pa.int64()) for c in columns], ["node", "n", "other"])
            out.clear()
            return done

        for batch in batches:
            if not batch.num_rows:
                continue
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in range(5):
                column = batch.column(c)
                change[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
            points = unit_rows(batch.column(7), width)
            node, n = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                here = tuple(batch.column(c)[low].as_py() for c in range(4))
                if here != key:
                    now.close(out)
                    now, key = Group(), here
                if batch.column(4)[low].as_py():
                    now.ask(node[low:high], n[low:high], points[low:high], out)
                else:
                    now.parts.append((node[low:high], n[low:high], points[low:high]))
                if len(out) > 50_000:
                    yield flushed()
        now.close(out)
        yield flushed()

    # Members come before queries, in the order of their nodes.
    return (entries.select(*group, "asks", "node", "n", "v").repartition(*group).sortWithinPartitions(*group, "asks", "node")
            .mapInArrow(run, "node long, n long, other long"))


def near_vectors(vectors: DataFrame, least: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    v = F.col(vector)
    judged = usable(v) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)) & F.col(label).isNotNull()
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                           F.transform(v, lambda x: F.when(x == 0, F.lit(0)).otherwise(x)).cast(vectors.schema[vector].dataType).alias("v"), F.coalesce(judged, F.lit(False)).alias("judged"))
    rows = named.where("judged").select("vec_id", "label", "v")
    alone = named.where("NOT judged").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    nodes = store(rows.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
                  .withColumn("node", F.monotonically_increasing_id()), "nodes")
    total, labels, width = nodes.agg(F.count("*"), F.approx_count_distinct("label"), F.max(F.size("v"))).first()
    if total:
        sample = nodes.select("v").orderBy(F.xxhash64("label", "v"), "v").limit(FIT).toArrow().column("v").combine_chunks()
        size = min(CODEWORDS, max(1, math.ceil((total / (PER_CELL * max(1, labels))) ** 0.5)))
        grid = Grid(unit_rows(sample, width), size)
        probing = store(probes(nodes, grid, width, cells_to_visit(nodes, grid, width, least), least), "probes")
        entries, cores = dealt(probing)
        found = store(compared(entries.join(nodes.select("node", "n", "v"), "node"), width, least).union(cores), "found")
        counts = found.groupBy("node").agg(F.sum("n").alias("links"))
        member = components(found.where("other IS NOT NULL").select(F.col("node").alias("u"), F.col("other").alias("v")))
        tied = member.join(nodes, "node").select("node", "root", "least")
        component = tied.join(tied.groupBy("root").agg(F.min("least").alias("component")), "root").select("node", "component")
        entry = nodes.join(counts, "node", "left").join(component, "node", "left").select(
            "label", "v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
        alone = alone.union(lookup(rows, entry, ["label", "v"], nodes.select("label", "v", "n")).select("vec_id", "n_links", "component_id"))
    return alone.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
