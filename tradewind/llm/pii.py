"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what they miss.

Base spans are matches of the patterns of KINDS with their tests; they are always kept. Candidates are numbers
with at least MIN_DIGITS digits and tokens with an @ or a spelled-out one. They form a chain in reading order;
distant candidates of the same or similar content (the same last digits, the same mailbox) are linked in turn
and share a potential. Loopy message passing gives each candidate the probabilities of its labels; one that no
base span touches becomes a span if a kind is likelier than all else.

The field is trained by numpy gradient descent on the pseudo-likelihood of at most TRAIN documents with
candidates, with base spans as labels: what they cover has their kind; any other candidate is no personal data,
unless it is linked to a covered one, in which case it is unknown and left out. What decides a pattern (the
plus, a check digit) is hidden in half of the rows, so that context and links have to be learned.

Null text counts as empty (no spans). Rows are kept as they are, with all columns (those named like the
results are replaced); an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import first_rows, only, shared

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN = 3000        # documents that the field is trained on, at most
MIN_DIGITS = 7
TAIL = 8            # numbers with the same last digits are similar
BUCKETS = 1 << 10
SETTLED = 1e-3      # message passing ends when no message changes by more
AGREE = 6.0         # potential of a link between candidates of one kind, before training
EPOCHS, RATE = 4, 0.2
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# the parts of the patterns behind their first sure character
AT = re.compile("@")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![\w.])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])+(?!\w)")
# a spelled mailbox: its sure part, and what follows it
SURE = re.compile(r"@| ?[\[(] ?at ?[\])] ?")
SPELLED = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]+)*")
BEFORE = re.compile(r"([^\W\d_]+)\W*$")


def mailboxes(text: str, sure: re.Pattern, tail: re.Pattern) -> Iterator[tuple[int, int]]:
    """Leftmost stretches of a local part, a sure part and a tail, looked for around each sure part, so that a long
    run of characters of local parts is walked once."""
    done, found = 0, sure.search(text)
    while found:
        start, at = found.start(), found.end()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        end = tail.match(text, at) if start < found.start() else None
        if end:
            done = end.end()
            yield start, done
            found = sure.search(text, done)
        else:
            found = sure.search(text, found.start() + 1)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the leftmost matches of the whole pattern."""
    return mailboxes(text, AT, DOMAIN) if "@" in text else iter(())


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in text.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """By kind, then start."""
    spans = [("email", s, e) for s, e in emails(text)]
    if re.search("[0-9]", text):
        spans += [("ip", *m.span()) for m in IP.finditer(text) if is_ip(m[0])]
        spans += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(n := digits(m[0])) <= 19 and luhn(n)]
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return spans


class Graph:
    """The candidates of a text: spans, features, links and what the base spans say."""

    def __init__(self, text: str, spans: list[tuple[str, int, int]]):
        self.spans, self.keys, self.features = [], [], []
        found = []
        for m in NUMBER.finditer(text):
            # more digits than any number has are several numbers side by side
            parts = [m.span()] if len(digits(m[0])) <= 19 else [
                (m.start() + p.start(), m.start() + p.end()) for p in re.finditer(r"[^ ]+", m[0])]
            found += [(s, e, False) for s, e in parts if len(digits(text[s:e])) >= MIN_DIGITS]
        if "@" in text or "at" in text:
            found += [(s, e, True) for s, e in mailboxes(text, SURE, SPELLED)]
        covered = sorted((s, e, kind) for kind, s, e in spans)
        starts = [s for s, _, _ in covered]
        self.label = []
        for start, end, mail in [*sorted(found)]:
            # a base span stands for all candidates that touch it
            i = int(np.searchsorted(starts, end, "left")) - 1 if starts else -1
            if i >= 0 and max(e for _, e, _ in covered[max(0, i - 3):i + 1]) > start:
                continue
            self._add(text, start, end, mail, 0)
        for start, end, kind in covered:
            self._add(text, start, end, kind == "email", LABELS.index(kind))
        order = sorted(range(len(self.spans)), key=self.spans.__getitem__)
        for name in ("spans", "keys", "features", "label"):
            setattr(self, name, [getattr(self, name)[i] for i in order])
        last: dict[str, int] = {}
        self.skips = []
        for i, keys in enumerate(self.keys):
            for key in keys:
                if key in last and last[key] < i and (last[key], i) not in self.skips[-4:]:
                    self.skips.append((last[key], i))
                last[key] = i

    def _add(self, text: str, start: int, end: int, mail: bool, label: int) -> None:
        own = text[start:end]
        number = digits(own)
        if mail:
            plain = re.sub(r" ?[\[(] ?dot ?[\])] ?", ".", re.sub(r" ?[\[(] ?at ?[\])] ?", "@", own)).lower()
            self.keys.append([f"m:{plain}"])
            shape = ["mail", f"dots:{min(plain.partition('@')[2].count('.'), 2)}"]
        else:
            self.keys.append([f"n:{number[-TAIL:]}"])
            shape = ["number", f"digits:{min(len(number), 20)}", f"dots:{min(own.count('.'), 4)}",
                     f"gaps:{min(sum(own.count(c) for c in ' ()-'), 4)}"]
        before = BEFORE.search(text, max(0, start - 40), start)
        context = [f"before:{before[1].lower()}" if before else "before:", f"sign:{text[start - 1:start]}"]
        # what decides a pattern is hidden from half of the training
        deciding = [] if mail else [f"plus:{own[:1] == '+'}", f"luhn:{13 <= len(number) <= 19 and luhn(number)}"]
        self.features.append(([bucket(f) for f in shape + context], [bucket(f) for f in deciding]))
        self.spans.append((start, end))
        self.label.append(label)


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) & BUCKETS - 1


class Field:
    """Weights: features by label, neighbours in the chain, and links."""

    def __init__(self):
        k = len(LABELS)
        self.unary, self.chain, self.skip = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros((k, k))
        self.skip[range(1, k), range(1, k)] = AGREE  # where training starts: few documents repeat an entity

    def fit(self, graphs: list[Graph], seed: int = 0) -> Field:
        """Gradient ascent on the pseudo-likelihood: each label given its neighbours'."""
        random = np.random.default_rng(seed)
        rows = []
        for graph in graphs:
            links: dict[int, list[int]] = {}
            for a, b in graph.skips:
                links.setdefault(a, []).append(b)
                links.setdefault(b, []).append(a)
            unknown = [graph.label[i] == 0 and any(graph.label[j] for j in links.get(i, ())) for i in range(len(graph.spans))]
            for i, label in enumerate(graph.label):
                if not unknown[i]:
                    near = [graph.label[j] for j in (i - 1, i + 1) if 0 <= j < len(unknown) and not unknown[j]]
                    far = [graph.label[j] for j in links.get(i, ()) if not unknown[j]]
                    rows.append((graph.features[i], near, far, label))
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            for at in random.permutation(len(rows)):
                (plain, deciding), near, far, label = rows[at]
                own = plain + deciding if random.random() < 0.5 else plain
                score = self.unary[own].sum(0) + self.chain[:, near].sum(1) + self.skip[:, far].sum(1)
                error = np.exp(score - score.max())
                error /= -error.sum()
                error[label] += 1
                self.unary[own] += rate * error[:, None].T
                for table, others in ((self.chain, near), (self.skip, far)):
                    for other in others:
                        table[:, other] += rate * error
                        table[other] += rate * error * (other != np.arange(len(LABELS)))
        return self

    def marginals(self, graph: Graph) -> np.ndarray:
        """Loopy message passing, all messages of a round at once, until they no longer change; labels of base
        spans are held. The rounds are bounded, as loops may not settle, by a multiple of the longest way a
        message can take."""
        n, k = len(graph.spans), len(LABELS)
        own = np.stack([self.unary[plain + deciding].sum(0) for plain, deciding in graph.features])
        held = np.array(graph.label)
        own[held > 0] = -1e4
        own[held > 0, held[held > 0]] = 0
        pairs = [(i, i + 1) for i in range(n - 1)] + graph.skips
        if pairs:
            tables = np.stack([self.chain if i < n - 1 else self.skip for i in range(len(pairs))])
            a, b = np.array(pairs).T
            source, target = np.concatenate([a, b]), np.concatenate([b, a])
            tables = np.concatenate([tables.transpose(0, 2, 1), tables])  # [edge, target label, source label]
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            messages = np.zeros((len(source), k))
            for _ in range(16 + 4 * n):
                belief = own.copy()
                np.add.at(belief, target, messages)
                joint = tables + (belief[source] - messages[back])[:, None, :]
                top = joint.max(2)
                after = top + np.log(np.exp(joint - top[:, :, None]).sum(2))
                after -= after.max(1)[:, None]
                change = np.abs(after - messages).max()
                messages = 0.5 * messages + 0.5 * after
                if change <= SETTLED:
                    break
            np.add.at(own, target, messages)
        own = np.exp(own - own.max(1)[:, None])
        return own / own.sum(1)[:, None]


def all_spans(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and base and added ones together, by kind and start."""
    base = base_spans(text)
    graph = Graph(text, base)
    added = []
    if 0 in graph.label:
        chances = field.marginals(graph)
        added = [(LABELS[int(c.argmax())], *span) for span, label, c in zip(graph.spans, graph.label, chances, strict=True)
                 if not label and c.argmax() and c.max() > 0.5]
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), *s[1:]))


def trained(docs: DataFrame, text: str = "text", at_most: int = TRAIN) -> Field:
    """From the first documents, by a hash of their id, in which a base pattern may match."""
    some = docs.where(F.col(text).rlike(r"@|\+[0-9]|[0-9][0-9 ().-]{7,}[0-9]"))
    rows = some.select("doc_id", F.col(text).alias("text")).where("doc_id is not null")
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)

    def graphs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only("pii")
        for frame in frames:
            made = [Graph(t, base_spans(t)) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": [g.label for g in made],
                                "skips": [[i for pair in g.skips for i in pair] for g in made],
                                "plain": [[" ".join(map(str, f[0])) for f in g.features] for g in made],
                                "deciding": [[" ".join(map(str, f[1])) for f in g.features] for g in made]})

    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, label array<int>, skips array<int>, plain array<string>, deciding array<string>"
    # of an id with many rows one is taken, before anything is made of it
    found = first_rows(rows.join(F.broadcast(chosen), "doc_id")).mapInPandas(graphs, kind).toPandas()
    made = []
    for row in found.sort_values("doc_id", kind="stable").itertuples():
        graph = Graph("", [])
        graph.label, graph.spans = [int(x) for x in row.label], [(0, 0)] * len(row.label)
        graph.skips = [(int(a), int(b)) for a, b in zip(row.skips[::2], row.skips[1::2], strict=True)]
        graph.features = [([*map(int, p.split())], [*map(int, d.split())]) for p, d in zip(row.plain, row.deciding, strict=True)]
        made.append(graph)
    return Field().fit(made)


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans) -> str:
    """The text with each stretch of spans replaced by the kind of its first span."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


OUTPUTS = {
    **{f"n_{kind}": ("bigint", lambda text, base, spans, kind=kind: sum(k == kind for k, _, _ in base)) for kind in KINDS},
    "base_sha256": ("string", lambda text, base, spans: hashlib.sha256(joined(base).encode()).hexdigest()),
    "spans": ("string", lambda text, base, spans: joined(spans)),
    "redacted": ("string", lambda text, base, spans: redacted(text, spans)),
}


def find(docs: DataFrame, field: Field, text: str = "text", outputs: tuple[str, ...] = ("spans", "redacted"),
         into: str = "pii") -> DataFrame:
    """All columns of docs and a struct `into` with the outputs named."""
    field_of = shared(docs.sparkSession, "pii", field)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = field_of()
        for texts in series:
            made: dict[str, list] = {name: [] for name in outputs}
            for value in texts:
                value = value or ""
                base, spans = all_spans(value, own)
                for name in outputs:
                    made[name].append(OUTPUTS[name][1](value, base, spans))
            yield pd.DataFrame(made, columns=list(outputs))

    kind = ", ".join(f"{name} {OUTPUTS[name][0]}" for name in outputs)
    return docs.withColumn(into, F.pandas_udf(run, kind)(F.col(text)))
