"""Best-fit packing of token sequences.

The plan is made over counts of lengths: lengths in falling order go to the open sequences with the least
room that still suffices, all sequences with the same room at once. It depends on at most `capacity` counts,
however many documents there are. Documents then take the planned places by their rank within their length.
Ranks are counted per (length, salt) and shifted by the counts of the salts before, so that a length that
holds a third of all pieces is not ranked in one task.

A document is its ids and then `end`. One longer than `capacity` is cut into full pieces, the first of which
may be shorter. Null text counts as empty (one piece: `end`). Repeated rows are packed as often as they come;
rows with a null doc_id too. An empty table gives an empty table. Columns that are not needed are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewind.llm.common import materialize, shared
from tradewind.llm.pretokens import Splitter

CACHE = 150_000         # pre-tokens remembered by a worker process
ROWS_PER_SALT = 50_000  # pieces of one length that are ranked together, about
SALTS = 4096            # at most


class Ids:
    """Ids of a text by a `tokenizers` file. A byte-level model encodes pre-tokens one by one, so each
    different pre-token is encoded once and remembered; any other tokenizer encodes the whole text."""

    def __init__(self, content: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        parts = json.loads(content)
        before = parts["pre_tokenizer"] or {}
        self.by_word = (parts["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"]
                        and not before["add_prefix_space"])
        if self.by_word:
            self.split, self.words = Splitter(pattern), WordIds(self.tokenizer.model)

    def __call__(self, text: str) -> np.ndarray:
        if not self.by_word:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        packed = b"".join(map(self.words.__getitem__, self.split(text)))
        if len(self.words) > CACHE:
            self.words.clear()
        return np.frombuffer(packed, np.uint32)


class WordIds(dict):
    """Packed ids by pre-token, from the model behind the pre-tokenizer."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def __missing__(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.encode("utf-8").decode("latin-1").translate(self.letters))
        packed = self[word] = array("I", [t.id for t in tokens]).tobytes()
        return packed


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be short of the capacity."""
    first = total % capacity or capacity
    return [(0, min(first, total)), *((s, capacity) for s in range(first, total, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    ids_by = shared(docs.sparkSession, "packing", Path(tokenizer_path).read_text(), lambda content: Ids(content, pattern))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = ids_by()
        for frame in frames:
            rows: list[tuple] = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = np.append(ids_of(text or ""), np.uint32(end)).astype("<u4")
                rows += [(doc_id, i, start, length, zlib.crc32(ids[start:start + length].tobytes()))
                         for i, (start, length) in enumerate(cut(len(ids), capacity))]
            made = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield made.astype({"doc_id": frame["doc_id"].dtype})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit over counts. Segments (length, first rank, first sequence, pieces a sequence, offset):
    the piece of that length with rank r goes to sequence first + (r - first rank) // pieces."""
    open_groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, number of sequences)
    segments, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        for room in [*sorted(r for r in open_groups if r >= length), capacity]:
            each = room // length  # a piece leaves the least room, so the next one joins it while it fits
            groups = open_groups.pop(room, []) if room < capacity else []
            while left and (groups or room == capacity):
                first, n = groups.pop() if groups else (sequences, -(-left // each))
                if first == sequences:
                    sequences += n
                full = min(n, left // each)
                for start, many, held in ((first, full, each), (first + full, min(n - full, 1), left - full * each)):
                    held = min(held, each)
                    if many and held:
                        segments.append((length, rank, start, held, capacity - room))
                        open_groups.setdefault(room - held * length, []).append((start, many))
                        rank, left = rank + many * held, left - many * held
                        first, n = start + many, n - many
                if n:
                    groups.append((first, n))
            if groups:
                open_groups.setdefault(room, []).extend(groups)
            if not left:
                break
    return segments


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    made = materialize(pieces(docs, tokenizer_path, pattern, capacity, end), "pieces")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = min(SALTS, 1 + max(counts.values(), default=0) // ROWS_PER_SALT * 4)
    salted = made.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt"))
                                         - F.col("n")).alias("before")))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("in_salt", F.row_number().over(own) - 1)
              .join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("in_salt")))
    by_length: dict[int, list] = {}
    for length, *segment in plan(counts, capacity):
        by_length.setdefault(length, []).append(segment)
    places = spark.sparkContext.broadcast({k: np.array(v, np.int64).T for k, v in by_length.items()})

    def run(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lengths, ranks in frames:
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length, rows in lengths.groupby(lengths.to_numpy()).indices.items():
                rank_at, first, each, base = places.value[length]
                r = ranks.to_numpy()[rows]
                at = np.searchsorted(rank_at, r, "right") - 1
                nth = r - rank_at[at]
                sequence[rows] = first[at] + nth // each[at]
                offset[rows] = base[at] + nth % each[at] * length
            yield pd.DataFrame({"sequence_id": sequence, "offset": offset})

    place = F.pandas_udf(run, "sequence_id bigint, offset bigint")
    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
