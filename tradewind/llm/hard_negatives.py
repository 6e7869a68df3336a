"""Hard negatives by Fagin's threshold algorithm over integer inner products.

Rows are dealt to shards of a bounded size. A shard keeps one sorted list of its rows for each dimension. An
anchor reads all lists in step, each from the end that its own component favours (the highest values where the
component is positive, the lowest where it is negative, none where it is zero); every row it meets is scored
at once from its whole vector. What an unread row can still score at most, the threshold, is the sum over the
lists of the anchor's component times the value last read. An anchor is done with a shard when the threshold is
strictly below the k-th score of each of its windows, or below the window's lower end. Steps grow by doubling.
A shard's answers are at most k rows a window; those of all shards are merged by (anchor, window).

The same search runs twice. First over the rows of the anchor's own label, with one window without ends: the
positives. Then over the rows of other labels, with a window for each positive. Blocks of anchors meet shards,
so neither side has to fit in one task; a label with many rows is many shards.

Rows with a null id or label, or a vector that is null or empty or holds a null or non-finite component take no
part. Of rows with one vec_id the one with the least (label, vector) counts, so repeated rows are one. Shorter
vectors count as filled up with zeros. Components are floor(scale * x) in 64 bits; components or scores beyond
them are an error. Ties go to the smaller vec_id. Fewer candidates give fewer rows, an empty table none. Further
columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import materialize
from tradewind.llm.exact import floored, integers, products
from tradewind.llm.vectors import usable

SHARD = 32_768   # rows of a shard, about
LEAST = 2048     # rows of a shard while the shards are fewer than SPREAD
SPREAD = 16
BLOCK = 4096     # anchors of a block, about
FIRST = 16       # entries of each list that are read in the first step
END = float("inf")


class Shard:
    """Rows with one sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")
        self.depths = [min(FIRST << n, len(ids)) for n in range(len(ids).bit_length() + 1) if FIRST << n < 2 * len(ids)] or [len(ids)]

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """For each anchor and depth the most that a row below that depth of all lists can score."""
        columns = np.arange(self.vectors.shape[1])
        at = np.array(self.depths) - 1
        low = self.vectors[self.lists[at], columns]
        high = self.vectors[self.lists[len(self.ids) - 1 - at], columns]
        return products(np.maximum(anchors, 0), high) + products(np.minimum(anchors, 0), low)

    def search(self, anchor: np.ndarray, threshold: np.ndarray, own: int, allowed: np.ndarray,
               windows: list[tuple[float, float]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (least, most) the ids and scores of its k best rows."""
        rising, falling = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = ~allowed | (self.ids == own)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        best = [(rows, scores)] * len(windows)
        live, before, n = set(range(len(windows))), 0, len(self.ids)
        for depth, most in zip(self.depths, threshold, strict=True):
            seen = np.zeros(n, bool)
            seen[self.lists[n - depth:n - before, rising].ravel()] = True
            seen[self.lists[before:depth, falling].ravel()] = True
            if depth == n:
                seen[:] = True  # an anchor of zeros reads no list
            new = np.flatnonzero(seen & ~met)
            met |= seen
            rows = np.concatenate([rows, new])
            scores = np.concatenate([scores, products(anchor[None, :], self.vectors[new])[0]])
            for w in list(live):
                least, top = windows[w]
                inside = np.flatnonzero((scores >= least) & (scores <= top))
                first = inside[np.lexsort((rows[inside], -scores[inside]))][:k]
                best[w] = rows[first], scores[first]
                # rows are in the order of their ids, so ties are too
                if most < least or (len(first) == k and most < scores[first[-1]]):
                    live.discard(w)
            if not live:
                break
            before = depth
        return [(self.ids[r], s) for r, s in best]


def shards_of(rows: int) -> int:
    return max(-(-rows // SHARD), min(SPREAD, -(-rows // LEAST)), 1)


def searching(width: int, k: int, same: bool):
    """Answers one block of anchors from one shard."""

    def run(anchors: pa.Table, data: pa.Table) -> pa.Table:
        out = []
        if data.num_rows and anchors.num_rows:
            coded = data.column("label").combine_chunks().dictionary_encode()
            number = {label: i for i, label in enumerate(coded.dictionary.to_pylist())}
            shard = Shard(data.column("vec_id").to_numpy(), coded.indices.to_numpy(), integers(data.column("v"), width))
            asked = integers(anchors.column("asked"), width)
            limits = shard.thresholds(asked)
            names, labels = anchors.column("anchor_id").to_pylist(), anchors.column("own").to_pylist()
            for i, windows in enumerate(anchors.column("windows").to_pylist()):
                ends = [(-END if w["least"] is None else w["least"], END if w["most"] is None else w["most"]) for w in windows]
                own = shard.labels == number.get(labels[i], -1)
                found = shard.search(asked[i], limits[i], names[i], own if same else ~own, ends, k)
                for w, (ids, scores) in zip(windows, found, strict=True):
                    out.append((np.full(len(ids), names[i]), np.full(len(ids), w["name"]), ids, scores))
        merged = [np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table(merged, names=["anchor_id", "window", "vec_id", "score"])

    return run


FOUND = "anchor_id bigint, window bigint, vec_id bigint, score bigint"
WINDOWS = "array<struct<name bigint, least bigint, most bigint>>"


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each window, with their rank."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def scaled(rows: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """vec_id, label, v: one row for each id that takes part."""
    good = rows.where(usable(F.col(vector)) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    made = good.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", floored(vector, scale).alias("v"))
    return made.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.*")


def mine(rows: DataFrame, positives: int = 5, negatives: int = 5, every: int = 100, least: int = 80, most: int = 100,
         scale: int = 256, vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (vec_id divisible
    by `every`) and each of its best rows of the same label the best rows of other labels whose score is between
    `least` and `most` hundredths of the positive's, ends included."""
    known = materialize(scaled(rows, scale, vector), "candidates")
    anchors = known.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("anchor_id"), F.col("label").alias("own"), F.col("v").alias("asked"))
    size = known.agg(F.count("*"), F.max(F.size("v")), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    total, width, asked = size[0], size[1] or 1, size[2]

    def part(key: str, parts) -> Column:
        return F.pmod(F.xxhash64(key), parts).cast("int")

    # shards and blocks of each label; a label's rows are counted before anything is sent
    per = known.groupBy("label").agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("a"))
    per = per.where("a > 0").select("label", F.greatest(F.ceil(F.col("n") / SHARD), F.least(F.lit(SPREAD), F.ceil(F.col("n") / LEAST)))
                                    .alias("shards"), F.ceil(F.col("a") / BLOCK).alias("blocks"))
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("name"), F.lit(None).cast("bigint").alias("least"),
                                  F.lit(None).cast("bigint").alias("most")))
    left = anchors.join(per, anchors["own"] == per["label"]).select(
        F.col("own").alias("kind"), part("anchor_id", F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("shards").cast("int") - 1)).alias("shard"), "anchor_id", "own", "asked", everything.alias("windows"))
    right = known.join(per, "label").select(
        F.col("label").alias("kind"), F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("block"),
        part("vec_id", F.col("shards")).alias("shard"), "vec_id", "label", "v")
    keys = ("kind", "block", "shard")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(searching(width, positives, True), FOUND)
    near = materialize(best_of(found, positives).select("anchor_id", F.col("vec_id").alias("positive_id"),
                                                        F.col("score").alias("positive_score")), "positives")

    # exact in decimals: the window's ends are scores, rounded inwards
    wide = F.col("positive_score").cast("decimal(22,0)")
    low, high = F.ceil(wide * least / 100).cast("bigint"), F.floor(wide * most / 100).cast("bigint")
    windows = (near.where(low <= high).groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("positive_id").alias("name"), low.alias("least"), high.alias("most")))).cast(WINDOWS).alias("windows")))
    blocks, shards = max(-(-asked // BLOCK), 1), shards_of(total)
    left = anchors.join(windows, "anchor_id").select(
        part("anchor_id", F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        "anchor_id", "own", "asked", "windows")
    right = known.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                         part("vec_id", F.lit(shards)).alias("shard"), "vec_id", "label", "v")
    keys = ("block", "shard")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(searching(width, negatives, False), FOUND)
    hard = materialize(best_of(found, negatives), "negatives")
    return hard.select("anchor_id", F.col("window").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
                       F.col("score").alias("negative_score")).join(near, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
