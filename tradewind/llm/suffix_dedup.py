"""Removes passages that also stand in a document with a smaller id, by difference-cover suffix sorting.

A byte goes if a window of `window` bytes that covers it also starts in a document with a smaller doc_id.
Windows are judged on the input, and never cross documents.

1. Anchors. The least hash of `gram` bytes in a window is its anchor (the leftmost of equals). Equal windows
   have equal anchors at the same place, so windows meet by their anchor's hash, and one record stands for
   the run of windows that share an anchor. An anchor seen in one document only has no repeated window.
   Records with the same bytes around the anchor (64 bits of hash beside the 64 of the anchor) are copies of
   each other: all but those in the smallest document go at once, before the shuffle already where a task
   holds several. The smallest document's record stands for them.
2. Suffix sorting. What different surroundings of one anchor have in common is not known yet. Their text
   is dealt out by the anchor and sorted there by a difference cover (suffix_array.py); adjacent suffixes with
   equal prefixes of a window form a class, and every window of a class outside its smallest document goes.
3. The runs found are put together by document.

All records travel as packed arrays, one per task and bucket. Buckets grow in number with the bytes of the
text; texts are dealt out by a hash of their row.

Null text counts as empty. A row with a null doc_id is compared with nothing and returned whole. Rows that
share a doc_id belong to one document: they never remove bytes from each other. With `apart`, rows with
different texts are different documents instead: those of one doc_id come in the order of a hash of their text,
those without one behind all others in that order. Repeated rows get the same result. An empty table gives an
empty table. Columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import materialize, only, release_memory
from tradewind.llm.suffix_array import equal_windows

BUCKET = 4 << 20     # bytes of text for each bucket: a task holds several copies of it beside the JVM's
SLICE = 1 << 18      # bytes hashed at once
HELD = 1 << 19       # anchor records held before they are packed
ROUND = 1 << 14      # surroundings sorted at once
PLACE = np.uint64((1 << 24) - 1)
LAST = (1 << 63) - 1  # stands for a null doc_id where rows are apart
M1, M2, S = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)
ANCHORS = "bucket bigint, doc binary, row binary, count binary, gram binary, around binary, lo binary, extra binary, lead binary"
RUNS = "shelf bigint, open boolean, row binary, count binary, gram binary, lo binary, extra binary, lead binary"
AROUND = "bucket bigint, doc binary, row binary, gram binary, lo binary, extra binary, lead binary, bytes binary"


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * M1
    x ^= x >> S
    return x


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k bytes, by doubling."""
    h, size = mixed(data.astype(np.uint64) + np.uint64(1)), 1
    while size < k:
        step = min(size, k - size)
        h = mixed(h[:-step] * M2 + h[step:] + np.uint64(size + step))
        size += step
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size < width:
        step = min(size, width - size)
        x, size = np.minimum(x[:-step], x[step:]), size + step
    return x


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple:
    """Runs of windows with one anchor in the pieces starts..ends of data: piece, hash of the anchor, hash of
    all bytes of the run, first window, further windows, distance of the anchor from the first window."""
    width = window - gram + 1
    hashes = gram_hashes(data, gram)
    keys = hashes & ~PLACE | np.arange(len(hashes), dtype=np.uint64)
    anchor = (sliding_min(keys, width) & PLACE).astype(np.int64)
    edge = np.zeros(len(anchor) + 1, np.int8)
    long = ends - starts >= window
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, (ends[long] - window + 1), -1)
    at = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    own = anchor[at]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)])
    piece = np.searchsorted(starts, at, "right") - 1
    new[1:] |= piece[1:] != piece[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    lo, hi, own = at[first], at[last], own[first]
    around = (hi - lo).astype(np.uint64) << np.uint64(32) | (own - lo).astype(np.uint64)
    for k in range(0, window + width - 1, gram):
        around = mixed(around * M2 + hashes[np.minimum(lo + k, hi + window - gram)])
    return piece[first], hashes[own], around, lo, hi - lo, own - lo


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end, and the place where each begins (and the last ends)."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], column.type)
    values = values.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def packed(kind: str, keys: np.ndarray, columns: dict[str, np.ndarray], fixed: dict | None = None) -> Iterator[dict]:
    """One row for each key; `row` and `doc` are stored once for each stretch of equal rows, with `count`."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    columns = {name: values[order] for name, values in columns.items()}
    for start, end in zip(cuts, [*cuts[1:], len(keys)], strict=True) if len(keys) else ():
        rows = columns["row"][start:end]
        heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        made = {kind: int(keys[start]), "count": np.diff(np.append(heads, len(rows))).astype("<u4").tobytes()}
        for name, values in columns.items():
            part = values[start:end]
            made[name] = (part[heads] if name in ("row", "doc") else part).tobytes()
        yield made | (fixed or {})


def arrow(rows: list[dict], ddl: str) -> pa.Table | pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])
    return pa.Table.from_pylist(rows, schema)


def unpacked(table: pa.Table, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    out = {name: np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), kind)
           for name, kind in kinds.items()}
    if "count" in out:
        for name in ("row", "doc"):
            if name in out:
                out[name] = np.repeat(out[name], out["count"])
        del out["count"]
    return out


def shelves(rows: np.ndarray, many: int) -> np.ndarray:
    return (rows.view(np.uint64) % np.uint64(many)).astype(np.int64)


def buckets(grams: np.ndarray, many: int) -> np.ndarray:
    return ((grams >> np.uint64(8)) % np.uint64(many)).astype(np.int64)


def run_rows(rows, lo, extra, many: int) -> Iterator[dict]:
    yield from packed("shelf", shelves(rows, many), {"row": rows, "lo": lo.astype("<u4"), "extra": extra.astype("<u4")},
                      {"open": False, "gram": b"", "lead": b""})


def join_windows(rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of neighbouring windows: row, first, further windows."""
    order = np.lexsort((places, rows))
    rows, places = rows[order], places[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (places[1:] > places[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1 if len(rows) else first
    return rows[first], places[first], places[last] - places[first]


def smallest(doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For records with equal keys: whether a smaller document has them; how many different further keys
    share the first key; whether several documents share it. Keys: the anchor and what is around it."""
    order = np.lexsort((doc, *keys[::-1]))
    ordered, first_key = doc[order], keys[0][order]
    group = np.ones(len(order), bool)
    group[1:] = first_key[1:] != first_key[:-1]
    run = group.copy()
    for key in keys[1:]:
        key = key[order]
        run[1:] |= key[1:] != key[:-1]
    heads, starts = np.flatnonzero(run), np.flatnonzero(group)
    later, kinds, shared = (np.empty(len(order), t) for t in (bool, np.int64, bool))
    later[order] = ordered > np.repeat(ordered[heads], np.diff(np.append(heads, len(order))))
    sizes = np.diff(np.append(starts, len(order)))
    kinds[order] = np.repeat(np.add.reduceat(run.astype(np.int64), starts), sizes)
    shared[order] = np.repeat(np.minimum.reduceat(ordered, starts) != np.maximum.reduceat(ordered, starts), sizes)
    return later, kinds, shared


def order_of(doc: np.ndarray, row: np.ndarray, apart: bool) -> np.ndarray:
    """What tells documents apart and which of them is smaller: the doc_id, or its rank together with the row."""
    if not apart or not len(doc):
        return doc
    order = np.lexsort((row, doc))
    new = np.zeros(len(order), bool)
    for key in (doc[order], row[order]):
        new[1:] |= key[1:] != key[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def find_anchors(window: int, gram: int, many: int, apart: bool = False):
    def pack(held: list[dict]) -> Iterator[dict]:
        if not held:
            return
        c = {name: np.concatenate([h.pop(name) for h in held]) for name in list(held[0])}
        later, _, _ = smallest(order_of(c["doc"], c["row"], apart), c["gram"], c["around"])
        for made in run_rows(c["row"][later], c["lo"][later], c["extra"][later], many):
            yield {"bucket": -1 - made.pop("shelf"), "doc": b"", "around": b""} | {k: v for k, v in made.items() if k != "open"}
        c = {name: values[~later] for name, values in c.items()}
        yield from packed("bucket", buckets(c["gram"], many), c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("suffix")
        held: list[dict] = []
        size = 0
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            row = batch.column("row").to_numpy(zero_copy_only=False).astype(np.int64)
            # pieces of at most a slice, overlapping so that each window lies in exactly one
            sizes = np.diff(offsets)
            pieces = np.maximum(1, -(-(sizes - window + 1) // SLICE))
            owner = np.repeat(np.arange(len(sizes)), pieces)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts = offsets[owner] + nth * SLICE
            ends = np.minimum(starts + SLICE + window - 1, offsets[owner + 1])
            at = 0
            while at < len(owner):
                end = at + 1
                while end < len(owner) and ends[end] - starts[at] <= 2 * SLICE:
                    end += 1
                low, high = starts[at], ends[end - 1]
                if high - low >= window:
                    # overlapping pieces of one text are laid out one after the other
                    lengths = ends[at:end] - starts[at:end]
                    begin = np.cumsum(lengths) - lengths
                    part = (data[low:high] if lengths.sum() == high - low else
                            np.concatenate([data[s:e] for s, e in zip(starts[at:end], ends[at:end], strict=True)]))
                    piece, grams, around, lo, extra, lead = anchors(part, begin, begin + lengths, window, gram)
                    own = owner[at:end][piece]
                    place = lo - begin[piece] + starts[at:end][piece] - offsets[own]
                    held.append({"doc": doc[own], "row": row[own], "gram": grams, "around": around, "lo": place.astype("<u4"),
                                 "extra": extra.astype("u1"), "lead": lead.astype("u1")})
                    size += len(own)
                at = end
                if size >= HELD:
                    yield from arrow(list(pack(held)), ANCHORS).to_batches()
                    held, size = [], 0
        yield from arrow(list(pack(held)), ANCHORS).to_batches()
        del held
        release_memory()

    return run


def judge_anchors(many: int, apart: bool = False):
    """Of one bucket: runs of windows that go at once, and those that are still open."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        only("suffix")
        release_memory()
        if key[0].as_py() < 0:
            made = unpacked(table, {"row": "<i8", "count": "<u4", "lo": "<u4", "extra": "<u4"})
            return arrow(list(run_rows(made["row"], made["lo"], made["extra"], many)), RUNS)
        c = unpacked(table, {"doc": "<i8", "row": "<i8", "count": "<u4", "gram": "<u8", "around": "<u8", "lo": "<u4",
                             "extra": "u1", "lead": "u1"})
        later, kinds, shared = smallest(order_of(c["doc"], c["row"], apart), c["gram"], c["around"])
        made = list(run_rows(c["row"][later], c["lo"][later], c["extra"][later], many))
        keep = shared & (kinds > 1) & ~later
        order = np.flatnonzero(keep)
        order = order[np.argsort(c["row"][order], kind="stable")]
        left = {name: c[name][order] for name in ("row", "gram", "lo", "extra", "lead")}
        left["extra"] = left["extra"].astype("<u4")
        made += packed("shelf", shelves(left["row"], many), left, {"open": True})
        return arrow(made, RUNS)

    return run


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


def cut_surroundings(window: int, many: int):
    """The text of the open runs of one shelf, dealt out by their anchor."""

    def run(docs: pa.Table, runs: pa.Table) -> pa.Table:
        only("suffix")
        c = unpacked(runs, {"row": "<i8", "count": "<u4", "gram": "<u8", "lo": "<u4", "extra": "<u4", "lead": "u1"})
        release_memory()
        if not len(c["row"]) or not docs.num_rows:
            return arrow([], AROUND)
        data, offsets = text_bytes(docs.column("text"))
        rows, first = np.unique(docs.column("row").to_numpy().astype(np.int64), return_index=True)
        which = first[np.searchsorted(rows, c["row"])]
        lengths = c["extra"].astype(np.int64) + window
        starts = offsets[which] + c["lo"]
        doc = docs.column("doc_id").to_numpy().astype(np.int64)[which]
        key = buckets(c["gram"], many)
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        made = []
        for part in np.split(order, cuts[1:]):
            made.append({"bucket": int(key[part[0]]), "doc": doc[part].tobytes(), "row": c["row"][part].tobytes(),
                         "gram": c["gram"][part].tobytes(), "lo": c["lo"][part].tobytes(),
                         "extra": c["extra"][part].astype("u1").tobytes(), "lead": c["lead"][part].tobytes(),
                         "bytes": gather(data, starts[part], lengths[part]).tobytes()})
        return arrow(made, AROUND)

    return run


def sort_surroundings(window: int, gram: int, many: int, apart: bool = False):
    """Windows of one bucket that stand in a smaller document, by suffix sorting."""
    width, half = window - gram + 1, (window - gram) // 2

    def run(table: pa.Table) -> pa.Table:
        only("suffix")
        release_memory()
        c = unpacked(table, {"doc": "<i8", "row": "<i8", "gram": "<u8", "lo": "<u4", "extra": "u1", "lead": "u1"})
        c["doc"] = order_of(c["doc"], c["row"], apart)
        data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
        extra, lead = c["extra"].astype(np.int64), c["lead"].astype(np.int64)
        lengths = extra + window
        starts = np.cumsum(lengths) - lengths
        # a window has the anchor and half of the rest on one side: surroundings that share neither half with
        # another document have no repeated window
        worth = np.zeros(len(lengths), bool)
        for has, at in ((lead >= half, starts + lead - half), (lengths - lead >= gram + half, starts + lead)):
            own = np.flatnonzero(has)
            h = np.zeros(len(own), np.uint64)
            for k in range(gram + half):
                h = (h ^ data[at[own] + k]) * M2
                h ^= h >> S
            _, _, shared = smallest(c["doc"][own], h)
            worth[own[shared]] = True
        keep = np.flatnonzero(worth)
        keep = keep[np.argsort(c["gram"][keep], kind="stable")]
        grams = c["gram"][keep]
        groups = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, int)
        groups = np.append(groups, len(grams))
        found_rows, found_places, at = [], [], 0
        while at < len(groups) - 1:
            end = max(at + 1, int(np.searchsorted(groups, groups[at] + ROUND, "right")) - 1)
            part = keep[groups[at]:groups[end]]
            at = end
            # equal windows hold the anchor at the same place, so a large group may be sorted by places in turn
            passes = min(width, -(-len(part) // ROUND))
            for low in range(0, width, -(-width // passes)):
                high = min(low + -(-width // passes), width) - 1
                shift = width - 1 - lead[part]                      # column of the first byte
                first, last = np.maximum(shift, low), np.minimum(shift + extra[part], high)
                live = first <= last
                own, shift, first, last = part[live], shift[live], first[live], last[live]
                if not len(own):
                    continue
                columns = np.arange(low, high + window)
                inside = columns - shift[:, None]
                rows = np.where((inside >= 0) & (inside < lengths[own][:, None]),
                                data[np.clip(starts[own][:, None] + inside, 0, len(data) - 1)], 0).astype(np.uint8)
                row, place, kind = equal_windows(rows, np.full(len(own), len(columns)), first - low, last - low, window)
                doc = c["doc"][own][row]
                heads = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
                least = np.minimum.reduceat(doc, heads)[kind]
                gone = doc > least
                found_rows.append(c["row"][own][row[gone]])
                found_places.append(c["lo"][own][row[gone]].astype(np.int64) + place[gone] + low - shift[row[gone]])
        if not found_rows:
            return arrow([], RUNS)
        return arrow(list(run_rows(*join_windows(np.concatenate(found_rows), np.concatenate(found_places)), many)), RUNS)

    return run


OUTPUTS = {
    "kept": (T.BinaryType(), pa.binary(), lambda kept: kept.tobytes()),
    "kept_text": (T.StringType(), pa.string(), lambda kept: kept.tobytes().decode("utf-8", "ignore")),
    "kept_sha256": (T.StringType(), pa.string(), lambda kept: hashlib.sha256(kept.tobytes()).hexdigest()),
}


def remove_runs(window: int, keep: list[str], outputs: tuple[str, ...]):
    def run(docs: pa.Table, runs: pa.Table) -> pa.Table:
        only("suffix")
        release_memory()
        c = unpacked(runs, {"row": "<i8", "count": "<u4", "lo": "<u4", "extra": "<u4"})
        data, offsets = text_bytes(docs.column("_text"))
        order = np.argsort(c["row"], kind="stable")
        rows, starts, ends = c["row"][order], c["lo"][order].astype(np.int64), (c["lo"] + c["extra"])[order].astype(np.int64) + window
        made: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "n_spans", *outputs)}
        own = docs.column("row").to_numpy().astype(np.int64)
        low, high = np.searchsorted(rows, own), np.searchsorted(rows, own, "right")
        for i in range(len(own)):
            text = data[offsets[i]:offsets[i + 1]]
            spans = 0
            kept = text
            if low[i] < high[i]:
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, starts[low[i]:high[i]], 1)
                np.add.at(edge, ends[low[i]:high[i]], -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = text[~gone]
            made["n_bytes"].append(len(text))
            made["n_removed"].append(len(text) - len(kept))
            made["n_spans"].append(spans)
            for name in outputs:
                made[name].append(OUTPUTS[name][2](kept))
        kinds = {name: OUTPUTS[name][1] for name in outputs}
        columns = [docs.column(name) for name in keep] + [pa.array(v, kinds.get(k, pa.int64())) for k, v in made.items()]
        return pa.table(columns, names=[*keep, *made])

    return run


def parts_of(size: int) -> int:
    """Buckets, and shelves, for so many bytes of text."""
    return max(8, -(-size // BUCKET))


def remove_repeats(docs: DataFrame, window: int = 50, text: str = "text", outputs: tuple[str, ...] = ("kept",),
                   keep: tuple[str, ...] | None = None, apart: bool = False) -> DataFrame:
    """The columns `keep` of docs (all by default), n_bytes, n_removed, n_spans (maximal removed runs) and the
    outputs named. Windows of 24 to 200 bytes."""
    if not 24 <= window <= 200:
        raise ValueError("window must be from 24 to 200 bytes")
    gram = 2 * window // 5
    results = {"n_bytes", "n_removed", "n_spans", "row", "shelf", "_text", *outputs}
    keep = [c for c in (keep or docs.columns) if c not in results]
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    many = parts_of(size)
    row = F.xxhash64(F.col("doc_id"), F.col(text))
    shelf = F.pmod(F.conv(F.hex(row), 16, 10).cast("decimal(20,0)"), F.lit(many)).cast("bigint")
    rows = docs.select(*keep, F.col(text).alias("_text"), row.alias("row"), shelf.alias("shelf"))
    doc_id = F.col("doc_id").cast("bigint")
    narrow = docs.select((F.coalesce(doc_id, F.lit(LAST)) if apart else doc_id).alias("doc_id"), F.col(text).alias("text"),
                         row.alias("row"), shelf.alias("shelf")).where("doc_id is not null")
    found = narrow.select("doc_id", "row", "text").mapInArrow(find_anchors(window, gram, many, apart), ANCHORS)
    runs = materialize(found.groupBy("bucket").applyInArrow(judge_anchors(many, apart), RUNS), "runs")
    around = (narrow.groupBy("shelf").cogroup(runs.where("open").groupBy("shelf"))
              .applyInArrow(cut_surroundings(window, 4 * many), AROUND))
    sorted_runs = materialize(around.groupBy("bucket").applyInArrow(sort_surroundings(window, gram, many, apart), RUNS), "sorted")
    schema = T.StructType([*[docs.schema[c] for c in keep],
                           *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
                           *[T.StructField(n, OUTPUTS[n][0]) for n in outputs]])
    return (rows.groupBy("shelf").cogroup(runs.where("not open").unionByName(sorted_runs).groupBy("shelf"))
            .applyInArrow(remove_runs(window, keep, outputs), schema))
