"""Byte-level BPE encoding and decoding.

Two tiers: a pre-token that is itself in the vocabulary is found by a minimal perfect hash; any other is
merged with a heap over a linked list of its bytes, lowest rank first and leftmost among equals.

Null text counts as empty. Rows, ties and further columns are kept as they are; an empty table gives an
empty table. Memory per task is a few copies of its longest text plus two caches of CACHE pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import shared
from tradewind.llm.pretokens import Splitter

CACHE = 200_000  # pre-tokens in each of the two generations that a worker process remembers
STEP, SPREAD, WORD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1  # odd multipliers for mixing hashes


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a rank file (base64 token and rank on each line)."""
    pairs = [line.split() for line in Path(path).read_bytes().splitlines() if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    return [tokens[i] for i in range(len(tokens))]


@dataclass
class PerfectHash:
    """Hash and displace: a bucket holds a shift that sends its keys to free slots, or, for a bucket of
    one key, that slot itself (negative). As many slots as keys."""

    shift: list[int]
    slots: int

    @classmethod
    def build(cls, keys: list[bytes]) -> tuple[PerfectHash, list[int]]:
        """Also the slot of each key."""
        n, m = len(keys), max(1, len(keys) // 4)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        bucket = (hashes % np.uint64(m)).astype(np.int64)
        members: list[list[int]] = [[] for _ in range(m)]
        for key, b in enumerate(bucket.tolist()):
            members[b].append(key)
        free, shift, place = np.ones(n, bool), [0] * m, [0] * n
        for b in sorted(range(m), key=lambda x: -len(members[x])):
            own = members[b]
            if len(own) < 2:
                break
            low, many = 0, 16
            while True:
                slots = cls._slots(hashes[own], np.arange(low, low + many, dtype=np.uint64)[:, None], n)
                slots_free = np.flatnonzero(free[slots].all(1))
                apart = np.sort(slots[slots_free], 1)
                good = slots_free[(apart[:, 1:] != apart[:, :-1]).all(1)]
                if len(good):
                    break
                low, many = low + many, min(4 * many, 1 << 16)
            shift[b] = low + int(good[0])
            for key, slot in zip(own, slots[good[0]].tolist(), strict=True):
                free[slot], place[key] = False, slot
        rest = iter(np.flatnonzero(free).tolist())
        for b, own in enumerate(members):
            if len(own) == 1:
                place[own[0]] = next(rest)
                shift[b] = -place[own[0]] - 1
        return cls(shift, n), place

    @staticmethod
    def _slots(hashes: np.ndarray, shifts: np.ndarray, n: int) -> np.ndarray:
        mixed = hashes + shifts * np.uint64(STEP)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(SPREAD)
        return ((mixed >> np.uint64(32)) % np.uint64(n)).astype(np.int64)

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % len(self.shift)]
        if d < 0:
            return -d - 1
        mixed = h + d * STEP & WORD
        return (((mixed ^ mixed >> 29) * SPREAD & WORD) >> 32) % self.slots


class Vocabulary:
    """Tokens of a rank file, prepared for encoding and decoding."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.hash, place = PerfectHash.build(tokens)
        self.rank_at = [0] * len(tokens)
        for rank, slot in enumerate(place):
            self.rank_at[slot] = rank

    def rank(self, piece: bytes) -> int | None:
        found = self.rank_at[self.hash.slot(piece)]
        return found if self.tokens[found] == piece else None

    def prepare(self) -> Vocabulary:
        """Adds what a worker derives for itself."""
        ranks = {token: i for i, token in enumerate(self.tokens)}
        self.byte_id = [ranks.get(bytes([b]), -1) for b in range(256)]
        none: dict[int, int] = {}
        self.pairs = [none] * len(self.tokens)  # ranks of pairs, by the left token and then by the right one
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    if self.pairs[left] is none:
                        self.pairs[left] = {}
                    self.pairs[left][right] = rank
        self.split = Splitter(self.pattern)
        self.kind = "H" if len(self.tokens) <= 1 << 16 else "I"
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        decimal = [f"{i},".encode() for i in range(len(self.tokens))]
        width = max(map(len, decimal))
        self.decimal = np.array(decimal, f"S{width}").view(np.uint8).reshape(-1, width)
        self.cache = Cache(self)
        return self

    def merge(self, piece: bytes) -> list[int]:
        """Heap of (rank, place) over linked bytes; `due` holds the rank of the pair that starts at a place."""
        ids, pairs = [self.byte_id[b] for b in piece], self.pairs
        if -1 in ids:
            raise ValueError("a byte of the text is not in the vocabulary")
        n = len(ids)
        due = [pairs[left].get(right) for left, right in zip(ids, ids[1:], strict=False)]
        due.append(None)
        heap = [rank << 40 | i for i, rank in enumerate(due) if rank is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while heap:
            entry = heappop(heap)
            i, rank = entry & 0xFFFFFFFFFF, entry >> 40
            if due[i] != rank:
                continue  # one side has been merged meanwhile
            j = after[i]
            ids[i], ids[j], due[j] = rank, -1, None
            k = after[i] = after[j]
            before[k] = i
            if k < n:
                due[i] = r = pairs[rank].get(ids[k])
                if r is not None:
                    heappush(heap, r << 40 | i)
            else:
                due[i] = None
            h = before[i]
            if h >= 0:
                due[h] = r = pairs[ids[h]].get(rank)
                if r is not None:
                    heappush(heap, r << 40 | h)
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> np.ndarray:
        packed = b"".join(map(self.cache.__getitem__, self.split(text)))
        if len(self.cache) > CACHE:
            self.cache.age()
        return np.frombuffer(packed, np.uint16 if self.kind == "H" else np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(total)
        return self.bytes[where].tobytes()

    def decimal_ids(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        digits = self.decimal[ids].ravel()
        return digits[digits != 0].tobytes()[:-1]


class Cache(dict):
    """Packed ids by pre-token; what is missing is resolved by the two tiers. A full cache becomes the old one: what
    is met again comes back from there, so pre-tokens that are used often are not resolved again."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.old = vocabulary, {}

    def __missing__(self, pretoken: str) -> bytes:
        packed = self.old.get(pretoken)
        if packed is None:
            v, piece = self.vocabulary, pretoken.encode()
            rank = v.rank(piece)
            packed = array(v.kind, [rank] if rank is not None else v.merge(piece)).tobytes()
        self[pretoken] = packed
        return packed

    def age(self) -> None:
        self.old = dict(self)
        self.clear()


OUTPUTS = {
    "n_tokens": (T.LongType(), lambda v, ids: len(ids)),
    "ids": (T.ArrayType(T.IntegerType()), lambda v, ids: ids.astype(np.int32)),
    "decoded": (T.BinaryType(), lambda v, ids: v.decode(ids)),
    "ids_sha256": (T.StringType(), lambda v, ids: hashlib.sha256(v.decimal_ids(ids)).hexdigest()),
    "decoded_sha256": (T.StringType(), lambda v, ids: hashlib.sha256(v.decode(ids)).hexdigest()),
}


def encoded(text: Column, vocabulary, outputs: tuple[str, ...]) -> Column:
    """A struct of the outputs named (see OUTPUTS). `vocabulary` gives workers the Vocabulary."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = vocabulary()
        for texts in series:
            made: dict[str, list] = {name: [] for name in outputs}
            for text in texts:
                ids = v.encode(text or "")
                for name in outputs:
                    made[name].append(OUTPUTS[name][1](v, ids))
            yield pd.DataFrame(made, columns=list(outputs))

    kind = T.StructType([T.StructField(name, OUTPUTS[name][0]) for name in outputs])
    return F.pandas_udf(run, kind)(text)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text",
           outputs: tuple[str, ...] = ("ids",), into: str = "bpe") -> DataFrame:
    """All columns of `df` and one struct column `into` (replaced if there) with the outputs."""
    vocabulary = shared(df.sparkSession, "bpe", Vocabulary(read_ranks(ranks_path), pattern), Vocabulary.prepare)
    return df.withColumn(into, encoded(F.col(text), vocabulary, outputs))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of `df` and the bytes of its ids; null ids give no bytes. Unknown ids are an error."""
    tokens_of = shared(df.sparkSession, "bpe tokens", read_ranks(ranks_path))

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = tokens_of()
        for rows in series:
            yield rows.map(lambda x: b"" if x is None else b"".join(tokens[i] for i in x))

    return df.withColumn(into, F.pandas_udf(run, T.BinaryType())(F.col(ids)))
