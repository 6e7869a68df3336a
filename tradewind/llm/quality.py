"""Quality scores by supervised subword embeddings.

Words and the character n-grams inside them are hashed to vectors, and so is the word bigram of a word and its
like (all such pairs are one feature); a document is the average of all of them; a softmax over two classes gives the score. Vectors and output weights are trained together by stochastic
gradient descent in numpy, on at most TRAIN labelled rows (the first by a hash of their id). Scoring is linear
up to the softmax, so each bucket's vector is multiplied with the output weights once, and a word is one
number and one count.

Null and empty texts have the score of the bias. Rows are kept as they are with all columns (those named like
the results are replaced); an empty table gives an empty table; without labels every score is 0.5. A doc_id
with several labels teaches with each.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import first_rows, shared

TRAIN = 2400       # labelled rows that the model learns from, at most
BUCKETS = 1 << 15
WIDTHS = (2, 3)
DIMENSIONS = 16
EPOCHS = 6
RATE = 1.0
CACHE = 150_000
SAME = zlib.crc32(b"a word and its like") & BUCKETS - 1
SAME_WEIGHT = 4    # such a pair counts like so many character n-grams


def features(word: str) -> list[int]:
    marked = f"<{word}>"
    grams = [marked[i:i + n] for n in WIDTHS for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode()) & BUCKETS - 1 for g in (*grams, f"={word}")]


@dataclass
class Model:
    weights: np.ndarray  # of a bucket: its vector times the difference of the output weights
    bias: float


class Words(dict):
    """Row numbers of the sums of words."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.sums, self.sizes, self.new = model, np.zeros(1024), np.zeros(1024), []

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at

    def of(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words of a text; those not met before are summed up together."""
        if len(self) > CACHE:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            while len(self) > len(self.sums):
                self.sums, self.sizes = np.tile(self.sums, 2), np.tile(self.sizes, 2)
            grams = [features(word) for word in self.new]
            sizes = np.fromiter(map(len, grams), np.int64, len(grams))
            flat = np.fromiter((g for own in grams for g in own), np.int64, sizes.sum())
            rows = slice(len(self) - len(grams), len(self))
            self.sums[rows] = np.add.reduceat(self.model.weights[flat], np.cumsum(sizes) - sizes)
            self.sizes[rows], self.new = sizes, []
        return at


def score(text: str, words: Words) -> float:
    found = text.split()
    logit = words.model.bias
    if found:
        at = words.of(found)
        same = SAME_WEIGHT * int((at[1:] == at[:-1]).sum())
        logit += (words.sums[at].sum() + same * words.model.weights[SAME]) / (words.sizes[at].sum() + same)
    return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    counts: Counter[int] = Counter()
    words = text.split()
    for word, n in Counter(words).items():
        for bucket in features(word):
            counts[bucket] += n
    if same := sum(map(str.__eq__, words, words[1:])):
        counts[SAME] += SAME_WEIGHT * same
    buckets = np.fromiter(counts, np.int64, len(counts))
    shares = np.fromiter(counts.values(), np.float32, len(counts))
    return buckets, shares / shares.sum() if len(shares) else shares


def descend(bags: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, seed: int = 0) -> Model:
    """Stochastic gradient descent over documents, at a falling rate."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    total, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(bags)):
            rate = RATE * (1 - step / total)
            step += 1
            buckets, shares = bags[i]
            hidden = shares @ vectors[buckets]
            logits = hidden @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[classes[i]] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            # an average moves its members by their shares; scaled so that frequent members learn as fast
            vectors[buckets] -= np.outer(rate * shares * min(len(shares), 100), back)
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, at_most: int = TRAIN) -> Model:
    """From documents with a label (doc_id, quality 0 or 1); null labels teach nothing. The labels chosen are
    at most `at_most` rows and are sent to all tasks, so texts are not shuffled."""
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int")).distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(at_most)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    # of an id with many rows one is taken, before anything is made of it
    sample = first_rows(texts).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")

    def bags(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [bag(t or "") for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": frame["quality"],
                                "buckets": [b.astype("<u4").tobytes() for b, _ in made],
                                "shares": [s.astype("<f4").tobytes() for _, s in made]})

    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality int, buckets binary, shares binary"
    found = sample.mapInPandas(bags, kind).toPandas().sort_values(["doc_id", "quality"], kind="stable")
    if found.empty:
        return Model(np.zeros(BUCKETS), 0.0)
    pairs = [(np.frombuffer(b, "<u4").astype(np.int64), np.frombuffer(s, "<f4"))
             for b, s in zip(found["buckets"], found["shares"], strict=True)]
    return descend(pairs, found["quality"].to_numpy().astype(int))


def rate(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of docs and the score, from 0 to 1."""
    words_of = shared(docs.sparkSession, "quality", model, Words)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = words_of()
        for texts in series:
            yield pd.Series([score(t or "", words) for t in texts], dtype="float64")

    return docs.withColumn(into, F.pandas_udf(run, "double")(F.col(text)))
