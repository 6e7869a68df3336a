"""Exact top-k by inner product of integer vectors: a Voronoi kNN join.

The largest inner product becomes the least distance when each data vector gets one more component that brings
it to the length of the longest, and each query a zero there. Pivots, a bounded sample of the data, cut space
into cells. Summaries of the cells (extent, the k least distances to the pivot) bound, for every query cell, how
far its k-th neighbour can be; data that is farther than that from all of the cell is not sent to it. Cells of
queries are put together to groups, and a large one is several groups; cells of data are dealt to parts by their
counts. The units solved locally are (group, data cell, part), for the cells within the group's bounds only, so
neither side needs to fit in one task; the best of each unit are merged by query.

Components are floor(scale * x) in doubles, in 64 bits; a component or a score beyond them is an error. Vectors that
are null or empty, or hold null or non-finite components, take no part; shorter vectors count as filled up with
zeros. Repeated rows are one; rows of equal vectors are answered as one query. Ties go to the smaller vec_id. Fewer
candidates than k give fewer rows. An empty table gives an empty table; further columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, shared
from tradewind.llm.exact import floored, integers, products
from tradewind.llm.vectors import best, matrix, points, spread, usable, with_point

PER_PIVOT = 2000   # points of a cell, about
PIVOTS = (12, 256)
PER_GROUP = 512    # query points of a group, about
PER_PART = 16_384  # points of a part of a data cell, about
BLOCK = 1 << 22    # scores made at once
SLACK = 1e-6       # of distances, for rounding


def scaled(rows: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """vec_id and v, the scaled integers."""
    return rows.where(usable(F.col(vector)) & F.col("vec_id").isNotNull()).select("vec_id", floored(vector, scale).alias("v"))


class Cells:
    """Pivots in the space with one more component, where the longest vector has length `reach`."""

    def __init__(self, pivots: np.ndarray, reach: float):
        self.reach = reach
        self.width = pivots.shape[1]
        self.pivots = self.lifted(pivots)

    def lifted(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.maximum(self.reach - (vectors ** 2).sum(1), 0) * (not query)
        return np.column_stack([vectors, np.sqrt(rest)])

    def distances(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        own = self.lifted(vectors, query)
        square = (own ** 2).sum(1)[:, None] + (self.pivots ** 2).sum(1) - 2 * own @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))


def bounds(cells: Cells, data: list, queries: list, k: int) -> np.ndarray:
    """For each query cell the distance from its pivot within which all neighbours lie (-1: no queries)."""
    n = len(cells.pivots)
    far = np.full(n, -1.0)
    # distances are differences of squares as large as the longest vector
    slack = SLACK * max(1.0, float(np.sqrt(cells.reach)))
    for cell, extent in queries:
        # a point at distance d of pivot j is at most extent + |pivot i, pivot j| + d away from any query
        between = np.sqrt(((cells.pivots[cell] - cells.pivots) ** 2).sum(1))
        reached = sorted(extent + between[j] + d for j, least in data for d in least)
        # with fewer points than k there is no bound
        theta = reached[k - 1] if len(reached) >= k else np.inf
        far[cell] = (extent + theta) * (1 + SLACK) + slack
    return far


class Plan:
    """Which group of queries meets which part of which data cell. It holds a few numbers for each cell."""

    def __init__(self, cells: Cells, data: list, queries: list, k: int):
        self.far = bounds(cells, [(c, least) for c, least, _, _ in data], [(c, e) for c, e, _ in queries], k)
        self.parts = np.ones(len(cells.pivots), np.int64)  # of each data cell
        for cell, _, _, n in data:
            self.parts[cell] = -(-n // PER_PART)
        self.first = np.zeros(len(cells.pivots), np.int64)  # group of each query cell; a large one has several
        self.many = np.ones(len(cells.pivots), np.int64)
        self.members: list[list[int]] = []
        filled = PER_GROUP
        for cell, _, n in queries:
            if n > PER_GROUP:
                self.many[cell] = -(-n // PER_GROUP)
                self.first[cell] = len(self.members)
                self.members += [[cell] for _ in range(self.many[cell])]
                filled = PER_GROUP
                continue
            if filled + n > PER_GROUP:
                self.members.append([])
                filled = 0
            self.first[cell] = len(self.members) - 1
            self.members[-1].append(cell)
            filled += n
        slack = SLACK * max(1.0, float(np.sqrt(cells.reach)))
        self.meets: list[list[int]] = []  # of each group the data cells that reach into its bounds
        for own in self.members:
            between = np.sqrt(((cells.pivots[own][:, None] - cells.pivots[None]) ** 2).sum(2)) if own else np.zeros((0, 0))
            self.meets.append([c for c, _, most, _ in data if (between[:, c] - most <= self.far[own] + slack).any()])


def nearest(rows: DataFrame, k: int = 5, scale: int = 256, every: int = 50, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for each row whose vec_id is divisible by `every`, against all others."""
    spark = rows.sparkSession
    named = materialize(with_point(scaled(rows, scale, vector).distinct()), "vectors")
    sources = materialize(points(named.select("vec_id", "v"), k + 1), "points")
    asked = named.where(F.col("vec_id") % every == 0).select("vec_id", "point")
    size = sources.agg(F.count("*"), F.max(F.size("v")),
                       F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).first()
    total, width, reach = size[0], size[1] or 1, size[2] or 0.0
    many = int(np.clip(total // PER_PIVOT, *PIVOTS))
    chosen = sources.orderBy(F.xxhash64("point"), "point").select("v").limit(many).collect()
    pivots = np.zeros((max(len(chosen), 1), width))
    for i, row in enumerate(chosen):
        pivots[i, :len(row["v"])] = row["v"]
    cells_of = shared(spark, "voronoi", Cells(pivots, reach))
    need = k + 1  # the query's own vector is among the data

    def assign(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = cells_of()
            for batch in batches:
                away = cells.distances(matrix(batch.column("v"), cells.width), query)
                cell = away.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("point"), batch.column("v"), pa.array(cell), pa.array(away[np.arange(len(cell)), cell])],
                    names=["point", "v", "cell", "away"])
        return run

    kind = "point bigint, v array<bigint>, cell bigint, away double"
    query_points = sources.join(asked.select("point").distinct(), "point", "left_semi").select("point", "v")
    data = materialize(sources.select("point", "v").mapInArrow(assign(False), kind), "cells")
    queries = materialize(query_points.mapInArrow(assign(True), kind), "queries")

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, away = batch.column("cell").to_numpy(), batch.column("away").to_numpy()
            for c in np.unique(cell):
                kept[int(c)] = np.sort(np.append(kept.get(int(c), []), away[cell == c]))[:need]
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.int64()),
                                          pa.array([v.tolist() for v in kept.values()], pa.list_(pa.float64()))],
                                         names=["cell", "least"])

    # at most PIVOTS rows reach the driver, with k + 1 distances each
    close = (data.select("cell", "away").mapInArrow(least, "cell bigint, least array<double>")
             .groupBy("cell").agg(F.slice(F.array_sort(F.flatten(F.collect_list("least"))), 1, need).alias("least")))
    wide = data.groupBy("cell").agg(F.max("away").alias("most"), F.count("*").alias("n"))
    held = sorted((r["cell"], r["least"], r["most"], r["n"]) for r in close.join(wide, "cell").collect())
    wanted = sorted((r["cell"], r["extent"], r["n"]) for r in
                    queries.groupBy("cell").agg(F.max("away").alias("extent"), F.count("*").alias("n")).collect())
    plan_of = shared(spark, "voronoi plan", Plan(Cells(pivots, reach), held, wanted, need))
    names = ["part", "cell", "slice", "point", "v"]

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, plan = cells_of(), plan_of()
        for batch in batches:
            away = cells.distances(matrix(batch.column("v"), cells.width), False)
            inside = away <= plan.far[None, :]
            slices = batch.column("point").to_numpy() % plan.parts[batch.column("cell").to_numpy()]
            for g, own in enumerate(plan.members):
                picked = np.flatnonzero(inside[:, own].any(1))
                if len(picked):
                    some = batch.take(pa.array(picked))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(picked), g)), some.column("cell"), pa.array(slices[picked]),
                                                      some.column("point"), some.column("v")], names=names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = plan_of()
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            group = plan.first[cell] + batch.column("point").to_numpy() % plan.many[cell]
            for g in np.unique(group):
                some = batch.take(pa.array(np.flatnonzero(group == g)))
                for c in plan.meets[g]:
                    for part in range(plan.parts[c]):
                        yield pa.RecordBatch.from_arrays([
                            *(pa.array(np.full(some.num_rows, x)) for x in (g, c, part)), some.column("point"), some.column("v")], names=names)

    def solve(queries: pa.Table, data: pa.Table) -> pa.Table:
        own, ids = integers(data.column("v"), width), data.column("point").to_numpy()
        asked, names = integers(queries.column("v"), width), queries.column("point").to_numpy()
        out = []
        step = max(1, BLOCK // max(len(own), 1))
        for low in range(0, len(asked) if len(own) else 0, step):
            scores = products(asked[low:low + step], own)
            row, column = best(scores, ids, need)
            out.append((names[low:low + step][row], ids[column], scores[row, column]))
        merged = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(merged, names=["query", "point", "score"])

    unit = "part bigint, cell bigint, slice bigint, point bigint, v array<bigint>"
    left = queries.select("cell", "point", "v").mapInArrow(send, unit)
    right = data.select("cell", "point", "v").mapInArrow(replicate, unit)
    found = materialize(left.groupBy("part", "cell", "slice").cogroup(right.groupBy("part", "cell", "slice"))
                        .applyInArrow(solve, "query bigint, point bigint, score bigint"), "found")
    return spread(found, asked, sources, k)
