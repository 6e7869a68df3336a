"""Prefix trie of conversations: a z-fast trie that grows in batches, as tables.

A conversation is a sequence of turns and stands for itself by its path: a hash for each of its prefixes, made of
the hash of the prefix before and of the turn. Equal hashes (128 bits of SHA-256) are equal prefixes. The trie is
compacted: a node is the root, the end of a conversation or where conversations part, and owns the edge of turns
above it, from depth `top` (excluded) to `depth`. It is found by its handle, the prefix whose length is the
2-fattest number in (top, depth]: the one with most trailing zero bits.

Locating a conversation is a fat binary search: the 2-fattest length of the interval that is left is looked up
among the handles; a hit moves the lower end to the node's depth if the whole edge agrees, and a miss moves the
upper end. Each step is one join for all conversations. One more join, by the first turn of edges, tells how far
the edge below agrees: the exit point. Inserting is done in batches: of all conversations that leave the trie at
the same point with the same next turn, the one with the least name goes in (names are hashes, so it is a random
one); edges are cut at exit points; the others search on from where they are. Each batch takes every waiting
conversation at least one turn deeper.

Conversations that are equal are one, with the number of their copies, before the trie is built. The ids that end
at a node are hashed in their order, in runs packed by the tasks of a range sort; no task holds them all.

Rows with a null conv_id take no part. Null roles and texts are empty. Turns are ordered by turn (nulls first),
then role, then SHA-256 of the text; rows that are repeated are turns of their own. A conversation without turns
ends at the root. An empty table gives an empty table. Further columns are not used. The path of one conversation
is one value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
SIZE = 16                                      # bytes of a hash
ROOT = hashlib.sha256(b"").digest()[:SIZE]     # the prefix without turns
RUN = 4096                                     # ids packed together


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with most trailing zero bits; low < high."""
    differing = low.bitwiseXOR(high)
    for step in (1, 2, 4, 8, 16):  # ones below the highest bit that differs
        differing = differing.bitwiseOR(F.shiftright(differing, step))
    return high.bitwiseAND(F.bitwise_not(F.shiftright(differing, 1)))


def prefixes(turns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Hashes of all prefixes, the empty one first, and the words in them, from hashes and words of turns in order."""
    for marks, words in turns:
        paths = []
        for own in marks:
            path = [ROOT]
            for mark in own:
                path.append(hashlib.sha256(path[-1] + mark).digest()[:SIZE])
            paths.append(path)
        yield pd.DataFrame({"path": paths, "sums": [np.concatenate([[0], np.cumsum(own)]).astype(np.int64) for own in words]})


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), mark (a hash of the turn), words of all turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.unhex(F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.sha2(text, 256).alias("print"), mark.alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "print")
    return rows.withColumn("pos", F.row_number().over(order) - 1).select("conv_id", "pos", "mark", "words")


def with_paths(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, path, sums (words up to each depth) of all convs (conv_id); turns: conv_id, pos, mark, words."""
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "mark", "words"))).alias("turns"))
    own = F.coalesce("turns", F.array().cast("array<struct<pos int, mark binary, words bigint>>"))
    made = convs.join(listed, "conv_id", "left").select("conv_id", own.alias("turns"))
    return made.select("conv_id", F.pandas_udf(prefixes, "path array<binary>, sums array<bigint>")("turns.mark", "turns.words").alias("made")).select("conv_id", "made.*")


def rebuilt(turns: DataFrame, heads: Column, most: int, family: int) -> DataFrame:
    """conv_id, path, sums of conversations that take their first `heads` turns (an expression of conv_id, up to
    `most`) from the first conversation of their family, that is conv_id - conv_id % family, and all further
    turns from themselves. turns: conv_id, turn, role, text."""
    rows = materialize(numbered(turns), "turns")
    convs = rows.select("conv_id").distinct().select("conv_id", heads.cast("int").alias("heads"),
                                                     (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    # only first turns are given away, each to at most `family` conversations on either side of zero
    giving = rows.where((F.col("conv_id") % family == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    given = convs.join(giving, "base").where("pos < heads").select("conv_id", "pos", "mark", "words")
    kept = rows.where(F.col("pos") >= heads)
    return with_paths(convs.select("conv_id"), given.unionByName(kept))


def strings_of(paths: DataFrame) -> DataFrame:
    """name, path, sums, least (conv_id), copies: one row for each different conversation."""
    return paths.groupBy(F.element_at("path", -1).alias("name")).agg(
        F.first("path").alias("path"), F.first("sums").alias("sums"), F.min("conv_id").alias("least"), F.count("*").alias("copies"))


NODE = ("end", "top", "depth", "up", "edge")


def with_handle(nodes: DataFrame) -> DataFrame:
    """Adds handle and head, the prefixes of the handle's length and of one turn of the edge; null at the root."""
    at = fattest(F.col("top"), F.col("depth"))
    return nodes.select(*NODE, F.when(F.col("depth") > 0, F.get("edge", at - F.col("top") - 1)).alias("handle"),
                        F.get("edge", F.lit(0)).alias("head"))


def locate(asked: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """Adds the exit point of each path: `low` (depth of the last node that agrees as a whole), `exit` (turns that
    agree) and `cut` (the node whose edge it is inside of, or null). asked: path, low; a path has under 2^steps
    turns. nodes: with_handle. `low` may be any depth known to be a node's."""
    names = asked.columns
    handles = nodes.where("depth > 0").select("handle", F.col("end").alias("_end"), F.col("top").alias("_top"), F.col("depth").alias("_depth"))
    state = asked.withColumn("_high", F.size("path") - 1)
    for _ in range(steps):
        at = F.when(F.col("low") < F.col("_high"), F.get("path", fattest(F.col("low"), F.col("_high"))))
        looked = state.withColumn("_at", at).join(handles, F.col("_at") == F.col("handle"), "left")
        hit, whole = F.col("_end").isNotNull(), F.get("path", F.col("_depth")).eqNullSafe(F.col("_end"))
        low = F.when(hit & whole, F.col("_depth")).when(hit, F.col("_top")).otherwise(F.col("low"))
        high = (F.when(hit & whole, F.col("_high")).when(hit, F.col("_top"))
                .when(F.col("_at").isNotNull(), fattest(F.col("low"), F.col("_high")) - 1).otherwise(F.col("_high")))
        state = looked.select(*(c for c in names if c != "low"), low.alias("low"), high.alias("_high"))
    below = nodes.where("depth > 0").select("head", F.col("end").alias("_end"), F.col("edge").alias("_edge"))
    found = state.join(below, F.get("path", F.col("low") + 1) == F.col("head"), "left")
    agreeing = F.aggregate(F.zip_with("_edge", F.slice("path", F.col("low") + 2, F.size("_edge")), lambda a, b: a.eqNullSafe(b)),
                           F.lit(0), lambda total, same: total + same.cast("int"))
    return found.select(*names, (F.col("low") + F.coalesce(agreeing, F.lit(0))).alias("exit"), F.col("_end").alias("cut"))


def cut_edges(nodes: DataFrame, points: DataFrame) -> DataFrame:
    """The nodes after edges are cut at points (cut, exit)."""
    at = points.distinct().groupBy(F.col("cut").alias("end")).agg(F.sort_array(F.collect_list("exit")).alias("cuts"))
    ends = F.concat(F.coalesce("cuts", F.array().cast("array<int>")), F.array("depth"))
    pieces = nodes.join(at, "end", "left").withColumn("_ends", ends).select(
        F.posexplode("_ends").alias("_n", "_depth"), "_ends", F.coalesce(F.get("_ends", F.col("_n") - 1), F.col("top")).alias("_top"),
        *NODE)
    end = F.when(F.col("_depth") == 0, F.col("end")).otherwise(F.get("edge", F.col("_depth") - F.col("top") - 1))
    up = F.when(F.col("_top") == F.col("top"), F.col("up")).otherwise(F.get("edge", F.col("_top") - F.col("top") - 1))
    return pieces.select(end.alias("end"), F.col("_top").alias("top"), F.col("_depth").alias("depth"), up.alias("up"),
                         F.slice("edge", F.col("_top") - F.col("top") + 1, F.col("_depth") - F.col("_top")).alias("edge"))


def build(strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes (end, top, depth, up, edge, handle, head) and, for each string, name and `owned`: the depth
    below which the string brought its turns to the trie. strings: name, path."""
    spark = strings.sparkSession
    longest = strings.agg(F.max(F.size("path"))).first()[0]
    if longest is None:
        longest, root = 1, []
    else:
        root = [(bytearray(ROOT), 0, 0, None, [])]
    steps = max(1, (longest - 1).bit_length())
    nodes = with_handle(spark.createDataFrame(root, "end binary, top int, depth int, up binary, edge array<binary>"))
    waiting = materialize(strings.select("name", "path", F.lit(0).alias("low")), "waiting")
    brought: list[DataFrame] = []
    while waiting.limit(1).count():
        found = materialize(locate(waiting, nodes, steps), "located")
        depth = F.size("path") - 1
        # one of all that leave at the same point with the same turn
        first = found.where(F.col("exit") < depth).groupBy(F.get("path", F.col("exit")).alias("at"), F.get("path", F.col("exit") + 1).alias("next")).agg(
            F.min("name").alias("name")).select("name")
        new = materialize(found.join(first, "name").select("name", "path", F.col("exit").alias("owned")), "inserted")
        inside = found.where(F.col("cut").isNotNull()).select("cut", "exit", "low", F.get("path", F.col("exit")).alias("at"))
        # an exit point at the end of an edge is a node already
        points = inside.where(F.col("at") != F.col("cut")).select("cut", "exit")
        leaves = new.select(F.col("name").alias("end"), F.col("owned").alias("top"), depth.alias("depth"),
                            F.get("path", F.col("owned")).alias("up"), F.slice("path", F.col("owned") + 2, depth - F.col("owned")).alias("edge"))
        nodes = materialize(with_handle(cut_edges(nodes, points).unionByName(leaves)), "nodes")
        brought.append(new.select("name", "owned"))
        # the exit point is a node now
        rest = found.where(F.col("exit") < depth).join(new.select("name"), "name", "left_anti")
        waiting = materialize(rest.select("name", "path", F.col("exit").alias("low")), "waiting")
    owned = spark.createDataFrame([], "name binary, owned int")
    for part in brought:
        owned = owned.unionByName(part)
    return nodes, owned


def ends(paths: DataFrame) -> DataFrame:
    """name, ends_sha256: the hash of the ids whose conversation it is, ascending, joined by commas."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids = batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()
            cuts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1] or i % RUN == 0] + [len(names)]
            yield pa.RecordBatch.from_arrays([
                pa.array([names[a] for a in cuts[:-1]], pa.binary()), pa.array([ids[a] for a in cuts[:-1]], pa.int64()),
                pa.array([",".join(map(str, ids[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.string())],
                names=["name", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, running = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if name != current:
                    if running is not None:
                        done.append((current, running.hexdigest()))
                    current, running = name, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())],
                                             names=["name", "ends_sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([running.hexdigest()], pa.string())],
                                             names=["name", "ends_sha256"])

    rows = paths.select(F.element_at("path", -1).alias("name"), "conv_id")
    runs = rows.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").mapInArrow(
        pack, "name binary, first bigint, ids string")
    return runs.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digest, "name binary, ends_sha256 string")


def node_report(paths: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every prefix of
    the conversations (conv_id, path, sums): see the statistics below. The edges of the trie are expanded."""
    paths = materialize(paths, "paths")
    strings = materialize(strings_of(paths), "strings")
    nodes, owned = build(strings.select("name", "path"))
    children = nodes.where("depth > 0").groupBy(F.col("up").alias("end")).agg(F.count("*").alias("n_children"))
    known = nodes.join(children, "end", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    leaf = known.select(F.col("end").alias("name"), (F.col("n_children") == 0).cast("int").alias("leaf"))
    # each string passes the nodes on its path; a turn of the trie counts for the string that brought it
    passing = (strings.join(leaf, "name").join(owned, "name", "left")
               .select("copies", "least", "leaf", "sums", F.coalesce("owned", F.size("path") - 1).alias("owned"),
                       F.posexplode("path").alias("depth", "end"))
               .join(nodes.select("end", "top"), "end"))
    total = F.element_at("sums", -1)
    below = passing.groupBy("end").agg(
        F.sum("copies").alias("n_convs"), F.min("least").alias("conv_id"), F.sum("leaf").alias("n_leaves"),
        # words below the node: of all conversations, and of the trie
        F.sum(F.col("copies") * (total - F.get("sums", F.col("depth")))
              - (total - F.get("sums", F.greatest("owned", "depth")))).alias("saved"),
        # up to the edge's depths, from its upper end; the same for all that pass
        F.first(F.slice("sums", F.col("top") + 1, F.col("depth") - F.col("top") + 1)).alias("sums"))
    full = materialize(known.join(below, "end"), "statistics")
    above = full.select(F.col("end").alias("up"), F.col("conv_id").alias("up_conv_id"))
    hashed = ends(paths).withColumnRenamed("name", "end")
    made = full.join(above, "up", "left").join(hashed, "end", "left")
    depths = F.when(F.col("depth") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.col("top") + 1, F.col("depth")))
    each = made.withColumn("at", F.explode(depths))
    last = F.col("at") == F.col("depth")
    words = F.when(F.col("at") == 0, F.lit(0)).otherwise(
        F.element_at("sums", -1) - F.get("sums", F.col("at") - F.col("top") - 1))
    return each.select(
        "conv_id", F.col("at").cast("bigint").alias("depth"),
        F.when(F.col("at") == F.col("top") + 1, F.col("up_conv_id")).when(F.col("at") > 0, F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(1).cast("bigint").alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * words).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))).otherwise(
            F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
