"""Chat formatting with loss masks aligned to token offsets.

A conversation is rendered as a whole and encoded once, with the code points each token covers. The sorted
spans of the texts to learn are intersected with the token spans by binary search; a token that reaches over
an edge is under the mask for the part inside.

Template: <|im_start|>role, line feed, text, <|im_end|>, line feed. "<|" in a role or text is written "<\\|"
(and "<\\|" as "<\\\\|" and so on), so control strings occur where the template puts them only, and the text
can be read back. A line feed in a role is written "\\n".

Turns are ordered by turn, then role and text; repeated rows are turns of their own. Null role or text counts
as empty, a null turn comes first, rows with a null conv_id form one conversation. A conversation is one value
and so is held by one task as a whole. An empty table gives an empty table; further columns are not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, processors

from tradewind.llm.common import shared

START, END = "<|im_start|>", "<|im_end|>"
TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns, learned: str) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts of the learned role."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def mask(offsets: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens under the mask, and the part of each that is: index, start, end. Tokens (rows of `offsets`) and
    spans are sorted. A token that covers several spans comes once for each."""
    if not len(offsets) or not len(spans):
        return (np.zeros(0, np.int64),) * 3
    first = np.searchsorted(offsets[:, 1], spans[:, 0], "right")  # the first token that ends behind the start
    last = np.searchsorted(offsets[:, 0], spans[:, 1], "left")    # the first that starts at the end or later
    many = np.maximum(last - first, 0)
    token = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    span = np.repeat(np.arange(len(spans)), many)
    return token, np.maximum(offsets[token, 0], spans[span, 0]), np.minimum(offsets[token, 1], spans[span, 1])


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray) -> str:
    """All text under the mask, unescaped. Tokens of one character's bytes share its code point."""
    parts, begin, reach = [], None, None
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if begin is not None and start <= reach:
            reach = max(reach, end)
            continue
        if begin is not None:
            parts.append(unescape(formatted[begin:reach]))
        begin, reach = start, end
    if begin is not None:
        parts.append(unescape(formatted[begin:reach]))
    return "".join(parts)


def load(content: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(content)
    tokenizer.encode_special_tokens = True
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets with the space before a word
    return tokenizer


OUTPUTS = {"formatted": "string", "ids": "array<int>", "loss_tokens": "array<int>", "loss_starts": "array<int>",
           "loss_ends": "array<int>", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint",
           "loss_sha256": "string", "formatted_chars": "bigint"}


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def chat_format(conversations: DataFrame, tokenizer_path: str, learned: str = "assistant",
                outputs: tuple[str, ...] = ("formatted", "ids", "loss_tokens", "loss_starts", "loss_ends")) -> DataFrame:
    """conv_id and the outputs named. loss_tokens are the places of tokens under the mask, loss_starts and
    loss_ends the code points of the part that is; digests and counts are read back from the output."""
    tokenizer_of = shared(conversations.sparkSession, "chat", Path(tokenizer_path).read_text(), load)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizer = tokenizer_of()
        for rows in series:
            made: dict[str, list] = {name: [] for name in OUTPUTS}
            for turns in rows:
                formatted, spans = render([(t["role"] or "", t["text"] or "") for t in turns], learned)
                encoded = tokenizer.encode(formatted, add_special_tokens=False)
                offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
                token, starts, ends = mask(offsets, np.array(spans, np.int64).reshape(-1, 2))
                back = TURN.findall(formatted)
                loss = masked_text(formatted, starts, ends)
                values = (formatted, encoded.ids, token.astype(np.int32), starts.astype(np.int32), ends.astype(np.int32),
                          len(back), _sha("".join(f"{unescape_role(r)}\n{unescape(t)}\n" for r, t in back)),
                          len(loss), _sha(loss), len(formatted))
                for name, value in zip(OUTPUTS, values, strict=True):
                    made[name].append(value)
            yield pd.DataFrame({name: made[name] for name in outputs}, columns=list(outputs))

    kind = ", ".join(f"{name} {OUTPUTS[name]}" for name in outputs)
    form = F.pandas_udf(run, kind)
    turns = (conversations.select("conv_id", "turn", "role", "text").groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))
    return turns.select("conv_id", form("turns").alias("chat")).select("conv_id", "chat.*")
