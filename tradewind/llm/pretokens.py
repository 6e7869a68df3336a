"""Splits text into pre-tokens by a byte-level BPE pattern."""

from __future__ import annotations

import re

import regex


class Splitter:
    """findall of the pattern. Texts of Latin-1 characters take the standard engine, with its
    letter, number and space classes written out; all others take the one that knows Unicode."""

    def __init__(self, pattern: str):
        self.general = regex.compile(pattern).findall
        listed = {name: re.escape("".join(chr(c) for c in range(256) if regex.match(name, chr(c))))
                  for name in (r"\p{L}", r"\p{N}", r"\s")}
        letters, numbers, spaces = listed.values()
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
        for name, members in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", spaces)):
            plain = plain.replace(name, f"[{members}]")
        self.latin = re.compile(plain.replace(r"\S", f"[^{spaces}]")).findall

    def __call__(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.general(text)
        return self.latin(text)
