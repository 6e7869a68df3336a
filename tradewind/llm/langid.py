"""Language identification of mixed text by scripts, word scores and Viterbi.

A word is a run of letters. The script of its first letter narrows the languages to those that use the script
in the training rows; hashed character n-grams and the word itself score it under each of them. Viterbi over
the words, with a penalty for every switch, labels spans; the language with most letters is predicted and its
share of the letters is the score. A text whose best single language cannot be beaten by any switch (the
largest sum of a stretch of other words' gains does not reach the penalty) needs no table of paths.

The model learns from at most TRAIN labelled rows, the first by a hash of their id, or from all; it is a table of
BUCKETS rows, summed up by Spark. Null text, and text without a letter, is `und` with score 0. Languages tie in
alphabetical order. Rows are kept as they are with all columns (those named like the results are replaced);
an empty table gives an empty table; without training rows everything is `und`.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import only, shared

TRAIN = 4000       # labelled rows that the model learns from, at most
BUCKETS = 1 << 16
WIDTHS = (2, 3)
FLOOR = -6.0       # a word counts this much against a language at most
SWITCH = 12.0      # penalty of a switch
RARE = 0.001       # a language uses a script that has at least this share of its words
CACHE = 100_000
GRAMS = 50_000     # n-grams whose buckets are remembered
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
# first code points of stretches and their scripts (fixed values)
SCRIPTS = ((0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"),
           (0x600, "arabic"), (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"),
           (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
           (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"))
STARTS = [start for start, _ in SCRIPTS]


def script_of(word: str) -> str:
    return SCRIPTS[bisect_right(STARTS, ord(word[0])) - 1][1]


def bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) & BUCKETS - 1


class Grams(dict):
    """Buckets of n-grams; words are made of the same few again and again."""

    def __missing__(self, gram: str) -> int:
        if len(self) >= GRAMS:
            self.clear()
        at = self[gram] = bucket(gram)
        return at


def features(word: str, bucket_of: Callable[[str], int] = bucket) -> list[int]:
    marked = f"^{word}$"
    grams = [marked[i:i + n] for n in WIDTHS for i in range(len(marked) - n + 1)]
    return [*map(bucket_of, grams), bucket(f"={word}")]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray                                 # log of the share of a bucket under each language
    scripts: dict[str, np.ndarray] = field(default_factory=dict)  # whether a language uses the script

    def scores(self, words: list[str], bucket_of: Callable[[str], int] = bucket) -> np.ndarray:
        """One row for each word; a word in a script that no language uses is no evidence."""
        grams = [features(word, bucket_of) for word in words]
        sizes = np.fromiter(map(len, grams), np.int64, len(grams))
        flat = np.fromiter(chain.from_iterable(grams), np.int64, sizes.sum())
        total = np.add.reduceat(self.table[flat], np.cumsum(sizes) - sizes)
        none = np.ones(len(self.languages), bool)
        scripts = list(map(script_of, words))
        kinds = {script: i for i, script in enumerate(dict.fromkeys(scripts))}
        kind = np.fromiter(map(kinds.__getitem__, scripts), np.int64, len(scripts))
        known = np.stack([self.scripts.get(script, none) for script in kinds])[kind]
        total = np.where(known, total, -np.inf)
        total = np.maximum(total - total.max(1, keepdims=True), FLOOR)
        total[np.array([script not in self.scripts for script in kinds])[kind]] = 0
        return total


class Words(dict):
    """Row numbers of the scores of words."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new, self.grams = model, [], Grams()
        self.rows = np.zeros((1024, len(model.languages)), np.float32)

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at

    def of(self, words: list[str]) -> np.ndarray:
        """Scores of the words of a text; those not met before are scored together."""
        if len(self) > CACHE:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            while len(self) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[len(self) - len(self.new):len(self)] = self.model.scores(self.new, self.grams.__getitem__)
            self.new = []
        return self.rows[at]


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The language of every word on the best path."""
    total = scores.sum(0, dtype=np.float64)
    best = int(total.argmax())
    steps = len(scores)
    if scores.shape[1] == 1:
        return np.zeros(steps, np.int64)
    others = np.delete(scores, best, 1).max(1)
    gained = np.concatenate([[0.0], np.cumsum(others - scores[:, best], dtype=np.float64)])
    if (gained - np.minimum.accumulate(gained)).max() <= penalty:
        return np.full(steps, best)
    values, back = scores[0].tolist(), []
    for row in scores[1:].tolist():
        top = max(values)
        floor = top - penalty
        back.append([k if v >= floor else -1 for k, v in enumerate(values)] + [values.index(top)])
        values = [(v if v >= floor else floor) + s for v, s in zip(values, row, strict=True)]
    at = values.index(max(values))
    path = [at]
    for pointers in reversed(back):
        at = pointers[at] if pointers[at] >= 0 else pointers[-1]
        path.append(at)
    return np.array(path[::-1])


def label(text: str, words: Words, penalty: float = SWITCH, spans: bool = True):
    """(language, score, spans of code points with their language)."""
    model = words.model
    found = LETTERS.findall(text.lower()) if model.languages else []
    if not found:
        return UNKNOWN, 0.0, []
    path = best_path(words.of(found), penalty)
    letters = np.fromiter(map(len, found), np.int64, len(found))
    share = np.bincount(path, letters, len(model.languages))
    best = int(share.argmax())
    stretches = []
    if spans:
        places = [m.span() for m in LETTERS.finditer(text)]
        if len(places) == len(path):  # lower-casing may split a word; then the whole text is one span
            cuts = np.flatnonzero(np.diff(path)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(path)], strict=True):
                stretches.append((places[low][0], places[high - 1][1], model.languages[path[low]]))
        else:
            stretches.append((places[0][0], places[-1][1], model.languages[best]))
    return model.languages[best], float(share[best] / share.sum()), stretches


def train(rows: DataFrame, at_most: int | None = TRAIN) -> Model:
    """From rows with doc_id, text and lang; null and empty ones teach nothing. Without `at_most`, all labelled rows
    are learned from, those without an id too."""
    sample = rows.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    if at_most is not None:
        known = sample.where("doc_id is not null")
        chosen = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)
        sample = known.join(F.broadcast(chosen), "doc_id")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only("langid")
        sums: dict[str, np.ndarray] = {}
        scripts: dict[tuple[str, str], int] = {}
        words: dict[str, Counter] = {}
        bucket_of = Grams().__getitem__

        def add(lang: str) -> None:
            """Adds up the words of a language that wait; a bucket counts once for each word, however often it has it."""
            own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for word, n in words.pop(lang).items():
                own[features(word, bucket_of)] += n
                key = (lang, script_of(word))
                scripts[key] = scripts.get(key, 0) + n

        for frame in frames:
            for text, lang in zip(frame["text"], frame["lang"], strict=True):
                waiting = words.setdefault(lang, Counter())
                waiting.update(LETTERS.findall(text.lower()))
                if len(waiting) > CACHE // 4:
                    add(lang)
        for lang in [*words]:
            add(lang)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "script": "", "bucket": at, "n": own[at]})
        for (lang, script), n in scripts.items():
            yield pd.DataFrame({"lang": [lang], "script": [script], "bucket": [-1], "n": [n]})

    # at most BUCKETS rows for each language
    counted = (sample.mapInPandas(count, "lang string, script string, bucket bigint, n bigint")
               .groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counted["lang"].unique())
    table = np.full((BUCKETS, len(languages)), 0.5)
    scripts: dict[str, np.ndarray] = {}
    for k, lang in enumerate(languages):
        own = counted[counted["lang"] == lang]
        grams, used = own[own["bucket"] >= 0], own[own["bucket"] < 0]
        table[grams["bucket"].to_numpy(), k] += grams["n"].to_numpy()
        for script, n in zip(used["script"], used["n"], strict=True):
            if n >= RARE * used["n"].sum():
                scripts.setdefault(script, np.zeros(len(languages), bool))[k] = True
    return Model(languages, np.log(table / table.sum(0)).astype(np.float32), scripts)


def identify(docs: DataFrame, model: Model, text: str = "text", penalty: float = SWITCH, spans: bool = True,
             into: str = "language") -> DataFrame:
    """All columns of docs and a struct `into`: lang_pred, score and, if asked for, spans (start, stop, lang)."""
    words_of = shared(docs.sparkSession, "langid", model, Words)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = words_of()
        for texts in series:
            made = [label(t or "", words, penalty, spans) for t in texts]
            frame = pd.DataFrame({"lang_pred": [m[0] for m in made], "score": [m[1] for m in made]})
            if spans:
                frame["spans"] = [[{"start": s, "stop": e, "lang": lang} for s, e, lang in m[2]] for m in made]
            yield frame

    kind = "lang_pred string, score double" + ", spans array<struct<start: int, stop: int, lang: string>>" * spans
    return docs.withColumn(into, F.pandas_udf(run, kind)(F.col(text)))
