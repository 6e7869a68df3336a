"""Suffix sorting by a difference cover modulo three, in numpy, up to a depth of one window.

The strings are the rows of a byte matrix; a suffix is a place in a row. Places 1 and 2 modulo 3 are the
sample. They are sorted by a triple of 8-byte words and named; triples of names are named again until a name
stands for a whole window. The remaining suffixes are sorted by their first byte and the name behind it, and
merged: against a sampled suffix, one or two bytes and the names behind them decide.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def named(columns: list[np.ndarray]) -> np.ndarray:
    """Dense ranks, from 1, of tuples given by columns."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for column in columns:
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new) + 1
    return names


def equal_windows(rows: np.ndarray, lengths: np.ndarray, first: np.ndarray, last: np.ndarray,
                  window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and class of every window that starts at places first..last (inclusive) of its row; two
    windows are equal if and only if their classes are. Windows come in the order of their suffixes."""
    n, width = rows.shape
    cover = 3 * WORD
    while cover < window + 2:
        cover *= 3
    full = np.zeros((n, width + 3 * WORD), np.uint8)
    full[:, :width] = rows
    full[:, :width][np.arange(width) >= lengths[:, None]] = 0
    words = np.zeros((n, width + 2 * WORD), np.uint64)
    for k in range(WORD):
        words |= full[:, k:k + width + 2 * WORD].astype(np.uint64) << np.uint64(8 * (WORD - 1 - k))

    # names of the sample; place 0 modulo 3 stays 0, as does what lies behind the row
    sample = np.flatnonzero(np.arange(width) % 3)
    names = np.zeros((n, width + 2 * cover), np.int64)
    names[:, sample] = named([words[:, sample + k * WORD].ravel() for k in range(3)]).reshape(n, -1)
    depth = 3 * WORD
    while depth < cover:
        again = np.zeros_like(names)
        again[:, sample] = named([names[:, sample + k * depth].ravel() for k in range(3)]).reshape(n, -1)
        names, depth = again, depth * 3

    places = np.arange(width)
    row, place = np.nonzero((places >= first[:, None]) & (places <= last[:, None]))
    kind = place % 3
    name = names[row, place]
    head = full[row, place].astype(np.int64)
    after = names[row, place + 1]
    two, behind = head << 8 | full[row, place + 1], names[row, place + 2]
    rest, sampled = np.flatnonzero(kind == 0), np.flatnonzero(kind != 0)
    rest = rest[np.lexsort((after[rest], head[rest]))]
    sampled = sampled[np.argsort(name[sampled], kind="stable")]
    key1 = np.sort((head << 48 | after)[kind == 1])
    key2 = np.sort((two << 46 | behind)[kind == 2])
    slot = (np.searchsorted(key1, (head << 48 | after)[rest])
            + np.searchsorted(key2, (two << 46 | behind)[rest]))
    # a remaining suffix stands before the sampled suffix of its slot
    order = np.insert(sampled, slot, rest)

    row, place = row[order], place[order]
    new = np.zeros(len(order), bool)
    for k in [*range(0, window - WORD, WORD), window - WORD]:  # adjacent prefixes, word by word
        word = words[row, place + k]
        new[1:] |= word[1:] != word[:-1]
    return row, place, np.cumsum(new)
