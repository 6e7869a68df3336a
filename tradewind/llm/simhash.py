"""SimHash fingerprints and exact near-duplicate groups by vantage-point trees.

A fingerprint has a bit set where over half of the 64-bit hashes of a document's word shingles have it.
Equal fingerprints are one point, so a group of copies of any size is one row from then on. Points are
dealt to shards by the leaves of a vantage-point tree, which is made from a bounded sample: a point is at
home on one side of each sphere, and a point inside a sphere that is within `radius` of its surface also
visits the outside, so that every linked pair meets in exactly the shards where one of the two is at home.
In a shard a local tree with the same triangle bounds finds the pairs; the shard returns stars (a link
from each point to the least point of its local group), never all pairs. Stars are joined to components.

Null text counts as empty: the zero fingerprint, linked like any other. Rows with the same doc_id are kept
as they are; the component is the least non-null doc_id of all linked rows (null if there is none). An empty
table gives an empty table. Further columns are kept unless they are named like the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import materialize
from tradewind.llm.components import components

SAMPLE = 4096       # fingerprints that the tree of shards is made from, at most
SHARD = 20_000      # points at home in a shard, about
LEAF = 256          # points in a leaf of a local tree
BLOCK = 1 << 20     # comparisons made at once
SEED = 42


def fingerprint_of(text: str, shingle: int) -> int:
    words = text.encode().lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:len(words) - shingle]]).tolist()
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(joined[s:e], SEED) for s, e in
                          zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at:at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed 64-bit number."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            made = np.array([fingerprint_of(t or "", shingle) for t in texts], np.uint64)
            yield pd.Series(made.view(np.int64))

    return F.pandas_udf(run, "bigint")(text)


def vantage_tree(sample: np.ndarray, leaves: int, radius: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, sphere, inside, outside); a negative child -s-1 is shard s. The vantage point of
    a node is, of a few sample points, the one whose best sphere leaves the fewest points near its surface."""
    nodes: list = []
    shards = 0

    def grow(points: np.ndarray, wanted: int) -> int:
        nonlocal shards
        best = None
        if wanted > 1 and len(points) >= 8:
            for vantage in points[np.linspace(0, len(points) - 1, 12).astype(int)]:
                far = np.bitwise_count(points ^ vantage).astype(int)
                inside = np.cumsum(np.bincount(far, minlength=65))
                for sphere in np.flatnonzero((inside >= len(points) * 0.25) & (inside <= len(points) * 0.75)):
                    copied = inside[sphere] - (inside[sphere - radius] if sphere >= radius else 0)
                    price = copied / len(points) + abs(inside[sphere] / len(points) - 0.5)
                    if best is None or price < best[0]:
                        best = (price, vantage, int(sphere), far)
        if best is None:
            shards += 1
            return -shards
        _, vantage, sphere, far = best
        at = len(nodes)
        nodes.append(None)
        nodes[at] = (int(vantage), sphere, grow(points[far <= sphere], wanted // 2),
                     grow(points[far > sphere], wanted - wanted // 2))
        return at

    root = grow(sample, leaves)
    return nodes if root >= 0 else []


def route(points: np.ndarray, nodes: list, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, shard, at home) of every shard a point is dealt to."""
    if not nodes:
        return np.arange(len(points)), np.zeros(len(points), np.int64), np.ones(len(points), bool)
    out, stack = [], [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        at, own, home = stack.pop()
        if not len(own):
            continue
        if at < 0:
            out.append((own, np.full(len(own), -at - 1), home))
            continue
        vantage, sphere, inside, outside = nodes[at]
        far = np.bitwise_count(points[own] ^ np.uint64(vantage)).astype(int)
        near = far <= sphere
        stack.append((inside, own[near], home[near]))
        crossing = near & (far > sphere - radius)
        stack.append((outside, np.concatenate([own[~near], own[crossing]]),
                      np.concatenate([home[~near], np.zeros(crossing.sum(), bool)])))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (
        np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool))


def local_groups(points: np.ndarray, radius: int) -> np.ndarray:
    """For each of the distinct points the index of the first point of its group under links of `radius`."""
    label = np.arange(len(points))

    def join(a: np.ndarray, b: np.ndarray) -> None:
        # links are taken in until every link has one label at both ends
        while True:
            la, lb = label[a], label[b]
            if (apart := la != lb).sum() == 0:
                return
            a, b = a[apart], b[apart]
            la, lb = la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label[label] != label).any():
                label[:] = label[label]

    # each entry: the points of a subtree, and the queries whose ball reaches it
    stack = [(np.arange(len(points)), np.arange(len(points)))]
    while stack:
        own, queries = stack.pop()
        if not len(own) or not len(queries):
            continue
        far = None
        if len(own) > LEAF:
            vantage = points[own[len(own) // 2]]
            far = np.bitwise_count(points[own] ^ vantage).astype(int)
            sphere = int(np.median(far))
            if far.max() == sphere:
                sphere -= 1
            if (far <= sphere).all() or not (far <= sphere).any():
                far = None
        if far is not None:
            away = np.bitwise_count(points[queries] ^ vantage).astype(int)
            stack.append((own[far <= sphere], queries[away <= sphere + radius]))
            stack.append((own[far > sphere], queries[away > sphere - radius]))
            continue
        step = max(1, BLOCK // len(own))
        for low in range(0, len(queries), step):
            block = queries[low:low + step]
            q, p = np.nonzero(np.bitwise_count(points[block][:, None] ^ points[own][None, :]) <= radius)
            a, b = block[q], own[p]
            join(a[a > b], b[a > b])
    return label


def point_links(points: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that join all points (distinct column `point`) of a group; a star in every shard."""
    spark = points.sparkSession
    total = points.count()
    share = min(1.0, SAMPLE / max(total, 1))
    # a stated sample by hash: the same after a lost executor; it only shapes the shards
    chosen = points.where(F.pmod(F.xxhash64("point"), F.lit(1 << 20)) < share * (1 << 20)).orderBy(
        F.xxhash64("point")).limit(2 * SAMPLE).collect()
    sample = np.array(sorted(r["point"] for r in chosen), np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(vantage_tree(sample, -(-total // SHARD), radius))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = frame["point"].to_numpy().astype(np.int64)
            which, shard, _ = route(own.view(np.uint64), tree.value, radius)
            yield pd.DataFrame({"shard": shard, "point": own[which]})

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        own = np.unique(frame["point"].to_numpy().astype(np.int64))
        label = local_groups(own.view(np.uint64), radius)
        other = label != np.arange(len(own))
        return pd.DataFrame({"a": own[other], "b": own[label[other]]})

    dealt = points.mapInPandas(deal, "shard bigint, point bigint")
    return dealt.groupBy("shard").applyInPandas(solve, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, text: str = "text",
                    keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns `keep` of docs (all by default) with `fingerprint` (16 hexadecimal digits) and
    `component_id`, the least doc_id that links lead to, itself included."""
    keep = tuple(c for c in (keep or docs.columns) if c not in ("fingerprint", "component_id"))
    printed = materialize(docs.select(*keep, fingerprint(F.col(text), shingle).alias("_point")), "fingerprints")
    points = materialize(printed.groupBy(F.col("_point").alias("point")).agg(F.min("doc_id").alias("first")), "points")
    grouped = components(point_links(points.select("point"), radius))
    known = points.join(grouped, points["point"] == grouped["node"], "left").select(
        "point", "first", F.coalesce("component", "point").alias("component"))
    least = known.groupBy("component").agg(F.min("first").alias("component_id"))
    # written, so that both sides of the last join come straight from a scan and a hot point can be split
    found = materialize(known.join(least, "component").select("point", "component_id"), "groups")
    return printed.join(found, printed["_point"] == found["point"]).select(
        *keep, F.lpad(F.lower(F.hex("_point")), 16, "0").alias("fingerprint"), "component_id")
