"""Approximate nearest neighbours by cosine: NN-descent and greedy search on the graph.

The graph starts from leaves of random-hyperplane trees (shaped by a bounded sample, and by one of its own where
a leaf is still too large) and is improved by joins of neighbours with neighbours until few links are new: every point gathers the points it links to and, up to `reverse` of them by a hash,
those that link to it; all of these are compared with each other, and each learns of the best it met that are
nearer than the worst it knows. Graph and walk use unit vectors in four bytes a component and compare by squared
distance from differences, which orders as the cosine does and stays exact where vectors nearly agree. A query
starts from its own point's links and expands the best points it knows, join by join, until all are expanded;
the best it found are scored by their original vectors.
Every point is indexed and every query is answered; the sample sizes (links, reverse links, beam) are the
parameters of the approximation, and recall against brute force is tested.

The score is the cosine of the original vectors in doubles. Vectors that are null, empty or zero, or hold null
or non-finite components, take no part; shorter vectors count as filled up with zeros. Equal vectors are one
point. Repeated rows are one. Ties go to the smaller vec_id; a point's score with itself is part of the
result for other rows of the same vector. An empty table gives an empty table; further columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, shared
from tradewind.llm.vectors import matrix, points, spread, usable, with_point

LINKS = 32      # of a point
REVERSE = 32    # points that link to a point, in one round
TREES = 6       # that the graph starts from
LEAF = 1000     # points in a leaf, about
SAMPLE = 8192   # points that shape the trees, at most
SPLIT = 64      # points that shape the further hyperplanes of a leaf that is too large, about
CHANGED = 0.02  # share of new links under which neighbours meet no more
MET = 12        # new neighbours a point learns of in one meeting
BEAM = 48       # points that a query expands in one step
WIDTH = 192     # points that a query remembers
RESCORED = 6    # times k points are scored by their original vectors
PART = 200_000  # links or members handled together, about
FARTHEST = -3.0  # below every score: minus half the squared distance of two unit vectors


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length one, safe for very large and very small components."""
    largest = np.abs(vectors).max(1, keepdims=True)
    vectors = vectors / np.where(largest > 0, largest, 1)
    length = np.sqrt((vectors ** 2).sum(1, keepdims=True))
    return vectors / np.where(length > 0, length, 1)


class Tree:
    """Hyperplanes, each halving the part of the sample that reaches it."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int):
        random = np.random.default_rng(seed)
        self.nodes: list = []
        self.leaves = 0

        def grow(own: np.ndarray, wanted: int) -> int:
            if wanted < 2 or len(own) < 4:
                self.leaves += 1
                return -self.leaves
            normal = random.standard_normal(own.shape[1])
            values = own @ normal
            middle = float(np.median(values))
            at = len(self.nodes)
            self.nodes.append(None)
            self.nodes[at] = (normal, middle, grow(own[values <= middle], wanted // 2),
                              grow(own[values > middle], wanted - wanted // 2))
            return at

        self.root = grow(sample, leaves)

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), np.int64)
        stack = [(self.root, np.arange(len(vectors)))]
        while stack:
            at, own = stack.pop()
            if at < 0:
                out[own] = -at - 1
            elif len(own):
                normal, middle, low, high = self.nodes[at]
                under = vectors[own] @ normal <= middle
                stack += [(low, own[under]), (high, own[~under])]
        return out


def further(leaf: np.ndarray, vectors: np.ndarray, level: dict[int, tuple[int, Tree]]) -> np.ndarray:
    """The leaves after those of `level` are split; each has its first new number and a tree."""
    out = leaf.copy()
    for old in np.unique(leaf):
        if int(old) in level:
            first, tree = level[int(old)]
            own = np.flatnonzero(leaf == old)
            out[own] = first + tree.leaf(vectors[own])
    return out


def halves(vectors: np.ndarray, most: int, seed: int = 0) -> list[np.ndarray]:
    """Parts of up to `most` vectors, cut by hyperplanes; for what is left above that when a leaf was split."""
    random, out, stack = np.random.default_rng(seed), [], [np.arange(len(vectors))]
    while stack:
        own = stack.pop()
        if len(own) <= most:
            out.append(own)
            continue
        order = own[np.argsort(vectors[own] @ random.standard_normal(vectors.shape[1]), kind="stable")]
        stack += [order[:len(order) // 2], order[len(order) // 2:]]
    return out


LINK_TABLE = "part bigint, point binary, near binary, score binary"


def code(vectors: np.ndarray) -> pa.Array:
    """Unit vectors in four bytes a component, for building and walking the graph."""
    return pa.array([row.tobytes() for row in unit(vectors).astype("<f4")], pa.binary())


def decoded(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, width)


def nearness(own: np.ndarray) -> np.ndarray:
    """Minus half the squared distance of all pairs, from their common mean: cosine less one for unit vectors, without
    the rounding of products near one."""
    own = own - own.mean(-2, keepdims=True)
    half = (own ** 2).sum(-1) / 2
    return np.minimum(own @ np.swapaxes(own, -1, -2) - half[..., :, None] - half[..., None, :], 0)


def links(point: np.ndarray, near: np.ndarray, score: np.ndarray, parts: int) -> pa.Table:
    """Packed by part: one row for each part that has links."""
    part = point % parts
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    own = [o for o in np.split(order, cuts) if len(o)]
    return pa.table([pa.array([int(part[o[0]]) for o in own], pa.int64()),
                     *(pa.array([x[o].tobytes() for o in own], pa.binary()) for x in (point, near, score.astype("<f4")))],
                    names=["part", "point", "near", "score"])


def merge(many: int):
    """The `many` best different links of each point of a part."""

    def run(table: pa.Table) -> pa.Table:
        point, near, score = (np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
                              for name, kind in (("point", "<i8"), ("near", "<i8"), ("score", "<f4")))
        # a link that was met twice may differ in the last bit of its score: the best copy stays
        order = np.lexsort((-score, near, point))
        point, near, score = point[order], near[order], score[order]
        new = np.ones(len(point), bool)
        new[1:] = (point[1:] != point[:-1]) | (near[1:] != near[:-1])
        point, near, score = point[new], near[new], score[new]
        order = np.lexsort((near, -score, point))
        point, near, score = point[order], near[order], score[order]
        heads = np.flatnonzero(np.concatenate([[True], point[1:] != point[:-1]]))
        sizes = np.diff(np.append(heads, len(point)))
        kept = np.arange(len(point)) - np.repeat(heads, sizes) < many
        cuts = pa.array(np.concatenate([[0], np.cumsum(np.minimum(sizes, many))]), pa.int32())
        return pa.table([pa.array(point[heads]), pa.ListArray.from_arrays(cuts, pa.array(near[kept])),
                         pa.ListArray.from_arrays(cuts, pa.array(score[kept]))], names=["point", "near", "scores"])

    return run


def meet_all(point: np.ndarray, vectors: np.ndarray, many: int) -> tuple[np.ndarray, ...]:
    """The `many` nearest of each point among all others: point, near, score."""
    order = np.argsort(point, kind="stable")
    point, vectors = point[order], vectors[order]
    scores = nearness(vectors)
    np.fill_diagonal(scores, -np.inf)
    many = min(many, len(point) - 1)
    if many < 1:
        return point[:0], point[:0], np.zeros(0, np.float32)
    column = np.argpartition(-scores, many - 1, axis=1)[:, :many]
    return np.repeat(point, many), point[column].ravel(), np.take_along_axis(scores, column, 1).ravel()


def meet_many(centre: np.ndarray, point: np.ndarray, worst: np.ndarray, vectors: np.ndarray,
              many: int) -> tuple[np.ndarray, ...]:
    """What each point of each gathering learns: up to `many` others nearer than the worst it links to."""
    order = np.lexsort((point, centre))
    centre, point = centre[order], point[order]
    keep = np.ones(len(order), bool)
    keep[1:] = (centre[1:] != centre[:-1]) | (point[1:] != point[:-1])
    order, centre, point = order[keep], centre[keep], point[keep]
    worst, vectors = worst[order], vectors[order]
    heads = np.flatnonzero(np.concatenate([[True], centre[1:] != centre[:-1]]))
    sizes = np.diff(np.append(heads, len(centre)))
    width, out = int(sizes.max()), []
    for low in range(0, len(heads), 128):
        at = heads[low:low + 128, None] + np.arange(width)
        live = np.arange(width) < sizes[low:low + 128, None]
        at = np.where(live, at, 0)
        scores = nearness(vectors[at])
        scores[~np.broadcast_to(live[:, None, :], scores.shape)] = -np.inf
        scores[:, np.arange(width), np.arange(width)] = -np.inf
        few = min(many, width - 1)
        if few < 1:
            continue
        column = np.argpartition(-scores, few - 1, axis=2)[:, :, :few]
        found = np.take_along_axis(scores, column, 2)
        better = (found > worst[at][:, :, None]) & live[:, :, None]
        group, row, nth = np.nonzero(better)
        out.append((point[at[group, row]], point[at[group, column[group, row, nth]]], found[group, row, nth]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (
        point[:0], point[:0], np.zeros(0, np.float32))


def backward(graph: DataFrame) -> DataFrame:
    """centre, member: for each point up to REVERSE of those that link to it, the first by a hash."""
    first = Window.partitionBy("centre").orderBy(F.xxhash64("member"), "member")
    return (graph.select(F.explode("near").alias("centre"), F.col("point").alias("member"))
            .withColumn("n", F.row_number().over(first)).where(F.col("n") <= REVERSE).drop("n"))


def both_ways(graph: DataFrame) -> DataFrame:
    """point, near: links and reverse links together."""
    back = backward(graph).groupBy(F.col("centre").alias("point")).agg(F.collect_list("member").alias("back"))
    return materialize(graph.select("point", "near").join(back, "point", "left").select(
        "point", F.array_union("near", F.coalesce("back", F.array().cast("array<bigint>"))).alias("near")), "adjacent")


def build(sources: DataFrame, total: int, width: int) -> tuple[DataFrame, DataFrame]:
    """The graph of (point, v) as point, near, scores (best first), and (point, code)."""
    spark = sources.sparkSession
    chosen = sources.orderBy(F.xxhash64("point"), "point").select("v").limit(SAMPLE).collect()
    sample = np.zeros((len(chosen), width))
    for i, row in enumerate(chosen):
        sample[i, :len(row["v"])] = row["v"]
    sample = unit(sample) if len(sample) else np.zeros((1, width))
    leaves = max(1, min(-(-total // LEAF), len(sample) // 8))
    trees_of = shared(spark, "trees", [Tree(sample, leaves, seed) for seed in range(TREES)])
    merging = max(1, total * LINKS * 4 // PART)
    meeting = max(1, total * (LINKS + REVERSE) // PART)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("point"), code(matrix(batch.column("v"), width))],
                                             names=["point", "code"])

    def dealing(splits_of):
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, splits = trees_of(), splits_of()
            for batch in batches:
                vectors = decoded(batch.column("code"), width)
                for i, tree in enumerate(trees):
                    leaf = tree.leaf(vectors) * len(trees) + i
                    for level in splits:
                        leaf = further(leaf, vectors, level)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column("point"), batch.column("code")],
                                                     names=["leaf", "point", "code"])

        return deal

    def start(table: pa.Table) -> pa.Table:
        table = table.sort_by("point")
        vectors, point = decoded(table.column("code"), width), table.column("point").to_numpy()
        return pa.concat_tables([links(*meet_all(point[own], vectors[own], LINKS), merging) for own in halves(vectors, 2 * LEAF)])

    def gather(table: pa.Table) -> pa.Table:
        centre, point, worst = (table.column(name).to_numpy() for name in ("centre", "member", "worst"))
        return links(*meet_many(centre, point, worst, decoded(table.column("code"), width), MET), merging)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, scores = batch.column("near"), batch.column("scores")
            point = np.repeat(batch.column("point").to_numpy(), np.diff(near.offsets.to_numpy()))
            yield from links(point, near.flatten().to_numpy(), scores.flatten().to_numpy(), merging).to_batches()

    codes = materialize(sources.select("point", "v").mapInArrow(coded, "point bigint, code binary"), "codes")
    kind = "leaf bigint, point bigint, code binary"
    splits: list[dict[int, tuple[int, Tree]]] = []
    number, whole = leaves * TREES + TREES, set()
    while True:
        # the name of the value differs from that of the trees, which stay
        dealt = codes.mapInArrow(dealing(shared(spark, "trees splits", splits)), kind)
        sizes = dealt.groupBy("leaf").count().where(F.col("count") > 2 * LEAF).collect()
        large = {r["leaf"]: r["count"] for r in sizes if r["leaf"] not in whole}
        if not large:
            break
        counts = spark.createDataFrame(list(large.items()), "leaf bigint, count bigint")
        share = F.pmod(F.xxhash64("point", "leaf"), F.lit(1 << 20)) * F.col("count") < SPLIT * (1 << 20)
        shaping: dict[int, list] = {}
        for row in sorted(dealt.join(F.broadcast(counts), "leaf").where(share).select("leaf", "point", "code").collect()):
            shaping.setdefault(row["leaf"], []).append(row["code"])
        level = {}
        for leaf, many in sorted(large.items()):
            own = decoded(pa.chunked_array([pa.array(shaping.get(leaf, []), pa.binary())]), width)
            tree = Tree(own, min(-(-many // LEAF), max(2, len(own) // 8)), leaf)
            # codes that no hyperplane parts are left to the task
            if tree.leaves > 1 and len(np.unique(own, axis=0)) > 1:
                level[leaf] = (number, tree)
                number += tree.leaves
            else:
                whole.add(leaf)
        if level:
            splits = [*splits, level]
    listed = "point bigint, near array<bigint>, scores array<float>"
    graph = materialize(dealt.groupBy("leaf").applyInArrow(start, LINK_TABLE).groupBy("part")
                        .applyInArrow(merge(LINKS), listed), "graph")
    changed = 1.0
    while changed > CHANGED:
        members = graph.select(F.col("point").alias("centre"), F.explode("near").alias("member")).unionByName(
            backward(graph)).unionByName(codes.select(F.col("point").alias("centre"), F.col("point").alias("member")))
        worst = F.when(F.size("scores") < LINKS, F.lit(FARTHEST)).otherwise(F.element_at("scores", -1)).cast("float")
        known = (codes.join(graph.select("point", worst.alias("worst")), "point", "left")
                 .select(F.col("point").alias("member"), "code", F.coalesce("worst", F.lit(FARTHEST).cast("float")).alias("worst")))
        met = (members.join(known, "member").withColumn("group", F.pmod(F.xxhash64("centre"), F.lit(meeting)))
               .groupBy("group").applyInArrow(gather, LINK_TABLE))
        before = graph.mapInArrow(held, LINK_TABLE)
        after = materialize(met.unionByName(before).groupBy("part").applyInArrow(merge(LINKS), listed), "graph")
        old = graph.select("point", F.col("near").alias("old"))
        new = F.size(F.array_except("near", F.coalesce("old", F.array().cast("array<bigint>"))))
        counted = after.join(old, "point", "left").agg(F.sum(new), F.sum(F.size("near"))).first()
        graph, changed = after, (counted[0] or 0) / max(counted[1] or 0, 1)
    return graph, codes


POOL = "query bigint, code binary, near array<bigint>, scores array<float>, done array<bigint>, turn array<bigint>"


def search(graph: DataFrame, codes: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """query, near: the points that the walk from each query point's own links found, best first. asked: (point)."""
    adjacent = both_ways(graph)

    def step(reached: pa.Table, pool: pa.Table) -> pa.Table:
        own = pool.to_pylist()[0]
        near, scores = np.array(own["near"], np.int64), np.array(own["scores"], np.float32)
        if reached.num_rows:
            others, first = np.unique(reached.column("other").to_numpy(), return_index=True)
            new = ~np.isin(others, near)
            apart = decoded(reached.column("code").take(first), width)[new] - np.frombuffer(own["code"], "<f4")
            found = -(apart ** 2).sum(1) / 2
            near, scores = np.concatenate([near, others[new]]), np.concatenate([scores, found])
        order = np.lexsort((near, -scores))[:WIDTH]
        near, scores = near[order], scores[order]
        done = [*own["done"], *own["turn"]]
        turn = near[~np.isin(near, done)][:BEAM]
        row = {"query": own["asker"], "code": own["code"], "near": near.tolist(), "scores": scores.tolist(),
               "done": done, "turn": turn.tolist()}
        return pa.Table.from_pylist([row], pa.schema([
            ("query", pa.int64()), ("code", pa.binary()), ("near", pa.list_(pa.int64())), ("scores", pa.list_(pa.float32())),
            ("done", pa.list_(pa.int64())), ("turn", pa.list_(pa.int64()))]))

    empty = F.array().cast("array<bigint>")
    pool = (asked.join(codes, "point").join(graph, "point", "left").select(
        F.col("point").alias("query"), "code", F.concat(F.array("point"), F.coalesce("near", empty)).alias("near"),
        F.concat(F.array(F.lit(0.0).cast("float")), F.coalesce("scores", F.array().cast("array<float>"))).alias("scores"),
        F.array("point").alias("done"), F.slice(F.coalesce("near", empty), 1, BEAM).alias("turn")))
    while True:
        pool = materialize(pool, "pool")
        if not pool.where(F.size("turn") > 0).limit(1).count():
            break
        opened = pool.select("query", F.explode("turn").alias("point")).join(adjacent, "point")
        reached = (opened.groupBy("query").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("others"))
                   .select("query", F.explode("others").alias("other")))
        coded = reached.join(codes.select(F.col("point").alias("other"), "code"), "other")
        pool = coded.groupBy("query").cogroup(pool.withColumnRenamed("query", "asker").groupBy("asker")).applyInArrow(step, POOL)
    return pool.select("query", "near")


def exact(found: DataFrame, sources: DataFrame, width: int, k: int) -> DataFrame:
    """query, point, score: the k best points by the cosine of the original vectors."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (unit(matrix(batch.column(name), width)) for name in ("v", "w"))
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("point"), pa.array((a * b).sum(1))],
                                             names=["query", "point", "score"])

    pairs = found.select("query", F.explode(F.slice(F.array_distinct("near"), 1, RESCORED * k)).alias("point"))
    scored = (pairs.join(sources.select(F.col("point").alias("query"), "v"), "query")
              .join(sources.select("point", F.col("v").alias("w")), "point")
              .select("query", "point", "v", "w").mapInArrow(score, "query bigint, point bigint, score double"))
    first = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    return scored.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k).drop("n")


def nearest(rows: DataFrame, k: int = 5, every: int = 50, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for each row whose vec_id is divisible by `every`, against all others."""
    good = rows.where(usable(F.col(vector)) & F.exists(vector, lambda x: x != 0) & F.col("vec_id").isNotNull())
    kind = rows.schema[vector].dataType.simpleString()
    exactly = kind if kind == "array<float>" else "array<double>"
    plain = good.select("vec_id", F.col(vector).cast(exactly).alias("v")).distinct()
    named = materialize(with_point(plain), "vectors")
    sources = materialize(points(named.select("vec_id", "v"), k + 1), "points")
    size = sources.agg(F.count("*"), F.max(F.size("v"))).first()
    total, width = size[0], size[1] or 1
    graph, codes = build(sources, total, width)
    asked = named.where(F.col("vec_id") % every == 0).select("vec_id", "point")
    walked = search(graph, codes, asked.select("point").distinct(), width)
    found = materialize(exact(walked, sources, width, k + 1), "found")
    return spread(found, asked, sources, k)
