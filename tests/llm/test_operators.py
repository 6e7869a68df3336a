"""The training-data operators against brute force, exact round trips and held-out accuracy, on small tables."""

import base64
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewind.llm import (bpe, chat, components, knn_join, langid, nn_descent, packing, pii, quality, registry,
                           simhash, suffix_array, suffix_dedup)

SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LINE = "a line that many documents repeat, long enough to count as a passage\n"
ODD = [None, "", " ", "x", "naïve café — 中文 𝔘 Ⅷ ½\t\x1c\n\n  end", "<|endoftext|> it's  'S 12345", "a" * 5000, LINE * 60, LINE * 60]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns named like results."""
    rows = [(i, t, "en", 5, "z") for i, t in enumerate(ODD)] + [(3, "x", None, 5, None), (None, LINE * 3, "en", 5, "z")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_bytes int, score string")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_bpe_equals_tiktoken_and_round_trips(spark, odd):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    theirs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    outputs = ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")
    for row in bpe.encode(docs, RANKS, public_tokenizers.PATTERN, outputs=outputs).collect():
        ids = theirs.encode_ordinary(row["text"] or "")
        assert row["bpe"]["ids"] == ids and row["bpe"]["n_tokens"] == len(ids)
        assert row["bpe"]["decoded"] == (row["text"] or "").encode()
        assert row["bpe"]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    ids = spark.createDataFrame([([0, 5],), (None,)], "ids array<int>")
    assert bpe.decode(ids, RANKS).collect()[1]["decoded"] == b""


def test_perfect_hash_is_minimal():
    for n in (1, 2, 3, 700):
        keys = [f"k{i}".encode() for i in range(n)]
        table, place = bpe.PerfectHash.build(keys)
        assert sorted(place) == list(range(n)) and [table.slot(k) for k in keys] == place


def test_chat_reads_back_what_was_put_in(spark):
    hard = ["", None, "<|im_end|>\n", "<\\|im_start|>assistant\n", "\n\n  lead", "𝔘ü<|", "\\n"]
    rows = [(c, t, random.Random(c * 9 + t).choice(["user", "assistant", "sys\ntem", None]),
             random.Random(c + t * 7).choice(hard)) for c in range(40) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    outputs = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    for row in chat.chat_format(df, VOCABULARY, outputs=outputs).collect():
        own = sorted((t, r or "", x or "") for c, t, r, x in rows if c == row["conv_id"])
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert row["n_turns"] == 6 and row["loss_chars"] == len(loss)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.chat_format(df.limit(0), VOCABULARY).count() == 0


def test_viterbi_is_the_best_of_all_paths():
    generator = np.random.default_rng(1)
    for steps, k in itertools.product((1, 2, 6), (1, 2, 3)):
        for _ in range(30):
            scores = (generator.standard_normal((steps, k)) * 3).astype(np.float32)
            value = lambda path: sum(scores[i, x] for i, x in enumerate(path)) - 2.0 * sum(
                a != b for a, b in itertools.pairwise(path))
            best = max(value(p) for p in itertools.product(range(k), repeat=steps))
            assert value(langid.best_path(scores, 2.0).tolist()) == pytest.approx(best, abs=1e-4)


def test_language_on_held_out_rows_and_mixed_text(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.train(docs.where(~held))
    rows = langid.identify(docs.where(held), model).select("lang", "language.lang_pred").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    texts = {r["lang"]: r["text"] for r in docs.where("lang in ('fr', 'de') and n_chars > 2000").collect()}
    mixed = texts["fr"][:900] + " " + texts["de"][:400]
    words = langid.Words(model)
    language, share, spans = langid.label(mixed, words)
    assert language == "fr" and 0.5 < share < 0.85 and [s[2] for s in spans] == ["fr", "de"]
    found = {r["doc_id"]: r["language"] for r in langid.identify(odd, model).where("doc_id < 3").collect()}
    assert [(found[i]["lang_pred"], found[i]["score"]) for i in range(3)] == [("und", 0.0)] * 3
    assert langid.train(docs.limit(0)).languages == []
    assert langid.identify(odd, langid.train(docs.limit(0))).where("language.lang_pred <> 'und'").count() == 0


def kept(docs, window=50):
    """Plain version of the removal of repeats."""
    least = {}
    for doc, text in docs:
        data = (text or "").encode()
        if doc is not None:
            for i in range(len(data) - window + 1):
                least[data[i:i + window]] = min(doc, least.get(data[i:i + window], doc))
    for doc, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - window + 1 if doc is not None else 0):
            if least[data[i:i + window]] < doc:
                gone[i:i + window] = True
        yield (doc, len(data), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()),
               hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())


@pytest.mark.parametrize("seed, part", [(0, 1 << 18), (1, 97), (2, 300)])
def test_repeats_equal_brute_force(spark, odd, monkeypatch, seed, part):
    chance = random.Random(seed)
    base = " ".join(chance.choice(["alpha", "bé", "gamma", "de", "the", "of", "x"]) for _ in range(400))
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for i in range(20, 70):
        a, b = sorted(chance.sample(range(len(base)), 2))
        text = list(base[a:b] + " ".join(chance.choice(["one", "two", "ü"]) for _ in range(40)))
        for _ in range(chance.randint(0, 4)):
            text[chance.randrange(len(text))] = chance.choice("qé")
        docs.append((i, "".join(text)))
    docs += [docs[20], docs[20], (20, "other " + base[:150]), (90, docs[30][1]), (91, docs[30][1])]
    monkeypatch.setattr(suffix_dedup, "SLICE", part)
    monkeypatch.setattr(suffix_dedup, "ROUND", 64 if seed else 1 << 14)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, n_spans int")
    got = suffix_dedup.remove_repeats(df, 50, outputs=("kept_sha256",)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert collected(got) == sorted(kept(docs), key=str)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_suffix_classes_are_those_of_equal_windows():
    generator = np.random.default_rng(3)
    rows = generator.integers(97, 99, (200, 40)).astype(np.uint8)
    rows[50:] = rows[generator.integers(0, 50, 150)]
    full = np.full(200, 40)
    row, place, kind = suffix_array.equal_windows(rows, full, np.zeros(200, int), full - 24, 24)
    classes = {}
    for r, p, k in zip(row, place, kind, strict=True):
        assert classes.setdefault(rows[r, p:p + 24].tobytes(), k) == k
    assert len(set(classes.values())) == len(classes) and len(row) == 200 * 17


def test_packing_is_best_fit_and_gapless(spark, odd):
    chance = random.Random(5)
    for _ in range(40):
        capacity = chance.choice([5, 10, 64])
        counts = {n: chance.randint(1, 30) for n in chance.sample(range(1, capacity + 1), chance.randint(1, 5))}
        rooms = []
        for n in sorted(counts, reverse=True):
            for _ in range(counts[n]):
                fitting = [r for r in rooms if r >= n]
                if fitting:
                    rooms.remove(min(fitting))
                rooms.append((min(fitting) if fitting else capacity) - n)
        sequences = {}
        for n, rank, first, each, at in packing.plan(counts, capacity):
            later = [r for m, r, *_ in packing.plan(counts, capacity) if m == n and r > rank]
            many = min(later, default=counts[n]) - rank
            for i in range(many):
                sequences.setdefault(first + i // each, []).append((at + i % each * n, n))
        assert len(sequences) == len(rooms)
        for places in sequences.values():
            assert sorted(places) == sorted(places, key=lambda p: p[0]) and sum(n for _, n in places) <= capacity
            assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(sorted(places)))
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    rows = packing.pack(odd, VOCABULARY, public_tokenizers.PATTERN, 64).collect()
    expected = []
    for row in odd.collect():
        ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0]
        for i, (start, length) in enumerate(packing.cut(len(ids), 64)):
            data = np.array(ids[start:start + length], "<u4").tobytes()
            expected.append((row["doc_id"], i, start, length, zlib.crc32(data)))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(expected, key=str)
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 64 and len(filled) <= 1.1 * sum(filled.values()) / 64 + 1
    assert packing.pack(odd.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def plain_spans(text):
    """The patterns as the contract words them."""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 13 <= len(pii.digits(m[0])) <= 19 and pii.luhn(pii.digits(m[0]))]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                    if 9 <= len(pii.digits(m[0])) <= 15]


def test_base_patterns_and_field(spark, odd):
    chance = random.Random(2)
    for _ in range(5000):
        text = "".join(chance.choice("a@.0 1-+9()2b5%\n") for _ in range(chance.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text)
    field = pii.trained(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    text = "call +49 30 1234567 now. Later 49 30 1234567 again. mail Bob.X@site.org or bob.x [at] site.org. id 12345678"
    base, spans = pii.all_spans(text, field)
    assert set(base) < set(spans) and {"49 30 1234567", "bob.x [at] site.org"} <= {text[s:e] for _, s, e in spans}
    assert "12345678" not in {text[s:e] for _, s, e in spans}
    rows = pii.find(odd, field, outputs=("spans", "redacted", "n_email")).collect()
    assert len(rows) == len(ODD) + 2 and all(r["pii"]["spans"] == "" for r in rows)
    assert pii.find(odd.limit(0), field).count() == 0


def test_a_megabyte_without_a_break_takes_little_time(spark):
    field = pii.trained(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    for text in ("a" * 1_000_000 + " [at] x@", "1" * 500_000 + "@" + "b" * 500_000, "a.b-" * 250_000, "x@ " * 200_000):
        started = time.perf_counter()
        pii.all_spans(text, field)
        assert time.perf_counter() - started < 5


def test_spelled_mailboxes_equal_the_plain_pattern():
    plain = re.compile(r"[A-Za-z0-9._%+-]+(?:@| ?[\[(] ?at ?[\])] ?)[A-Za-z0-9-]+(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]+)*")
    chance = random.Random(3)
    for _ in range(5000):
        text = "".join(chance.choice(["a", "@", ".", " ", "[at]", "(at )", " [ dot ] ", "-", "b_", "(", "at"]) for _ in range(chance.randint(0, 25)))
        assert list(pii.mailboxes(text, pii.SURE, pii.SPELLED)) == [m.span() for m in plain.finditer(text)]


def test_many_rows_of_one_id_teach_as_one(spark):
    rows = [(7, f"call +49 30 1234567 or {i}") for i in range(3000)] + [(8, "mail a@b.org")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    pii.trained(docs)
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, quality int")
    assert quality.rate(docs.limit(5), quality.train(docs, labels)).count() == 5
    assert quality.rate(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0


@pytest.mark.parametrize("doubt", [5.0, 5.9, 6.2])
def test_field_reaches_all_repeats_of_an_entity(doubt):
    text = "call +49 30 1234567 now" + ", or 49 30 1234567 now" * 30
    graph = pii.Graph(text, pii.base_spans(text))
    assert len(graph.skips) == 30 and graph.label == [pii.LABELS.index("phone")] + [0] * 30
    field = pii.Field()
    plain, deciding = graph.features[1]
    field.unary[plain[0], 0] = doubt - field.unary[plain + deciding, 0].sum()
    got = field.marginals(graph)
    # the links are one chain: forward and backward sums are exact
    own = np.stack([field.unary[a + b].sum(0) for a, b in graph.features])
    own[0] = np.where(np.arange(len(pii.LABELS)) == graph.label[0], 0, -1e4)
    step = lambda scores: np.log(np.exp(field.skip + (scores - scores.max())[None, :]).sum(1)) + scores.max()
    ahead, back = [own[0]], [np.zeros(len(pii.LABELS))]
    for i in range(1, 31):
        ahead.append(own[i] + step(ahead[-1]))
        back.append(step(back[-1] + own[31 - i]))
    exact = np.stack(ahead) + np.stack(back[::-1])
    exact = np.exp(exact - exact.max(1)[:, None])
    exact /= exact.sum(1)[:, None]
    assert np.abs(got - exact).max() < 0.01
    assert (got.argmax(1) == exact.argmax(1)).all()


def test_quality_on_held_out_rows(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = quality.train(docs, labels.where(~held))
    rows = quality.rate(docs.drop("source").where(held).join(labels, "doc_id"), model).select("quality", "score").collect()
    assert np.mean([(r["score"] >= 0.5) == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in quality.rate(odd, model).collect())
    assert {r["score"] for r in quality.rate(odd, quality.train(docs, labels.limit(0))).collect()} == {0.5}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_equal_brute_force(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    near = docs.limit(40).select((F.col("doc_id") + 10_000).alias("doc_id"), F.concat("text", F.lit(" more")).alias("text"))
    rows = [(r["doc_id"], r["text"]) for r in docs.unionByName(near).collect()] + [(20_000 + i, t) for i, t in enumerate(ODD)]
    points = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (points[i] ^ points[j]).bit_count() <= 3:
            label[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, component_id int")
    got = collected(simhash.near_duplicates(df, keep=("doc_id",)))
    assert got == sorted(((d, f"{p:016x}", least[find(i)]) for i, ((d, _), p) in enumerate(zip(rows, points, strict=True))), key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_vantage_tree_brings_linked_points_together():
    generator = np.random.default_rng(0)
    points = generator.integers(0, 2 ** 63, 400).astype(np.uint64)
    points = np.unique(np.concatenate([points, points ^ np.uint64(7), points ^ np.uint64(1 << 40 | 1)]))
    where, shard, home = simhash.route(points, simhash.vantage_tree(points[::2], 8, 3), 3)
    shards = {i: set(shard[where == i]) for i in range(len(points))}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    assert home.sum() == len(points) and all(shards[a] & shards[b] for a, b in zip(*np.nonzero(near), strict=True))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


@pytest.fixture(scope="module")
def vectors(spark):
    """Close vectors, a very common one, ties, zero, null and non-finite ones."""
    generator = np.random.default_rng(4)
    rows = [(i, generator.standard_normal(8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(100)] + [rows[7], rows[7]]
    rows += [(500, None), (550, []), (600, [0.0] * 8), (650, [float("nan")] * 8), (700, [None] + [1.0] * 7), (None, rows[1][1])]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def brute(vectors, score, usable, k=5):
    rows = {r["vec_id"]: r["embedding"] for r in vectors.collect() if r["vec_id"] is not None and usable(r["embedding"])}
    for q in sorted(rows):
        if q % 50 == 0:
            others = sorted((-score(rows[q], v), i) for i, v in rows.items() if i != q)[:k]
            yield from ((q, n, i, -s) for n, (s, i) in enumerate(others, 1))


def finite(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def test_topk_equals_brute_force(vectors):
    product = lambda a, b: sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b, strict=True))
    assert collected(knn_join.nearest(vectors)) == sorted(brute(vectors, product, finite), key=str)
    assert knn_join.nearest(vectors.limit(0)).count() == 0
    few = vectors.where("vec_id in (0, 1, 50)")
    assert collected(knn_join.nearest(few)) == sorted(brute(few, product, finite), key=str)


def test_topk_of_large_components_and_split_cells(spark, monkeypatch):
    for name, value in (("PER_PIVOT", 40), ("PIVOTS", (4, 8)), ("PER_GROUP", 5), ("PER_PART", 30)):
        monkeypatch.setattr(knn_join, name, value)
    random_ = np.random.default_rng(8)
    rows = [(i, (random_.standard_normal(5) * 10.0 ** random_.integers(-2, 3)).tolist()) for i in range(400)]
    rows += [(1000 + i, (np.array([1, 1, 1, 1, 1]) + 0.01 * random_.standard_normal(5)).tolist()) for i in range(250)]  # one dense cell
    rows += [(2000, [1e7, 0.5, 0.0, 0.0, 0.0]), (2001, [0.5, 1e7, 1.0, 0.0, 0.0]), (2050, [0.5, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id bigint, embedding array<double>, rank string, score int")
    product = lambda a, b: sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b, strict=True))
    got = collected(knn_join.nearest(df))
    assert got == sorted(brute(df, product, finite), key=str)
    assert (2050, 1, 2000, 327680000000) in got


def test_nn_descent_recall(vectors):
    cosine = lambda a, b: round(float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)), 9)
    wanted = list(brute(vectors, cosine, lambda v: finite(v) and any(v)))
    got = nn_descent.nearest(vectors).collect()
    assert len(got) == len(wanted)
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in got}
    hit = [(q, i) in found for q, _, i, _ in wanted]
    assert np.mean(hit) >= 0.9
    assert all(found[q, i] == pytest.approx(s, abs=1e-8) for q, _, i, s in wanted if (q, i) in found)
    assert nn_descent.nearest(vectors.limit(0)).count() == 0


def test_nn_descent_recall_over_many_leaves(spark, monkeypatch):
    # a sample that shapes few leaves, a third of the vectors in one dense cluster
    for name, value in (("LEAF", 20), ("SAMPLE", 64), ("TREES", 2), ("LINKS", 10), ("REVERSE", 10), ("BEAM", 6), ("WIDTH", 48)):
        monkeypatch.setattr(nn_descent, name, value)
    random = np.random.default_rng(5)
    own = random.standard_normal((3000, 12))
    own[::3] = own[0] + 0.2 * own[::3]
    own = own.astype(np.float32)[random.permutation(3000)]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(own)], "vec_id bigint, embedding array<float>")
    lengths = own / np.linalg.norm(own, axis=1, keepdims=True)
    scores = lengths[::20] @ lengths.T
    scores[np.arange(150), np.arange(0, 3000, 20)] = -2
    wanted = {(20 * q, int(i)) for q, near in enumerate(np.argsort(-scores, axis=1)[:, :5]) for i in near}
    got = {(r["query_id"], r["vec_id"]) for r in nn_descent.nearest(rows, k=5, every=20).collect()}
    print("recall", len(got & wanted) / len(wanted))
    assert len(got) == len(wanted) and len(got & wanted) >= 0.9 * len(wanted)


def test_nn_descent_recall_where_vectors_nearly_agree(spark):
    """Tight clusters, and vectors that all point nearly the same way: one byte a component tells them not apart."""
    random = np.random.default_rng(3)
    middles = random.standard_normal((20, 32))
    for own in (middles[random.integers(0, 20, 1000)] + 0.01 * random.standard_normal((1000, 32)),
                random.standard_normal((1000, 32)) + 10):
        own = own.astype(np.float32).astype(float)
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(own)], "vec_id bigint, embedding array<double>")
        lengths = own / np.linalg.norm(own, axis=1, keepdims=True)
        scores = lengths[::50] @ lengths.T
        scores[np.arange(20), np.arange(0, 1000, 50)] = -2
        wanted = {(50 * q, int(i)) for q, near in enumerate(np.argsort(-scores, axis=1)[:, :5]) for i in near}
        got = {(r["query_id"], r["vec_id"]) for r in nn_descent.nearest(rows).collect()}
        assert len(got) == len(wanted) and len(got & wanted) >= 0.95 * len(wanted)


def test_a_link_met_twice_is_one_link():
    """Copies of a link whose scores differ in the last bit, with another link between them."""
    score = np.array([0.5, np.nextafter(np.float32(0.5), np.float32(1)), 0.5, 0.4], np.float32)
    table = nn_descent.links(np.array([3, 3, 3, 3]), np.array([9, 9, 4, 8]), score, 1)
    found = nn_descent.merge(3)(table).to_pylist()
    assert [r["near"] for r in found] == [[9, 4, 8]]


def test_nn_descent_answers_name_a_row_once(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    got = nn_descent.nearest(rows).collect()
    assert len({(r["query_id"], r["vec_id"]) for r in got}) == len(got) == 200
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in rows.collect()}
    names = np.array(sorted(vectors))
    own = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in names])
    wanted = set()
    for q in names[names % 50 == 0]:
        scores = own @ own[names == q][0]
        scores[names == q] = -2
        wanted |= {(int(q), int(i)) for i in names[np.lexsort((names, -scores))[:5]]}
    assert len(wanted & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.95 * len(wanted)


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry.queries())
    assert numbers == list(range(1, 14)) and registry.oracle_sql().keys() <= registry.queries().keys()


def test_pre_tokens_in_use_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    vocabulary, asked = bpe.Vocabulary(ranks, public_tokenizers.PATTERN).prepare(), []
    rank = vocabulary.rank
    monkeypatch.setattr(vocabulary, "rank", lambda piece: asked.append(piece) or rank(piece))
    for n in range(40):
        vocabulary.encode(" ".join(["", "everywhere", *(f"rare{chr(97 + n % 26)}{i}x{n}" for i in range(8))]))
        assert len(vocabulary.cache) + len(vocabulary.cache.old) < 300
    assert len(vocabulary.cache.old) and asked.count(b" everywhere") == 1


def test_buckets_of_n_grams_are_remembered(monkeypatch):
    plain = [langid.features(word) for word in ("straße", "straßen", "señor")]
    hashed, crc32 = [], zlib.crc32
    monkeypatch.setattr(langid.zlib, "crc32", lambda gram: hashed.append(gram) or crc32(gram))
    grams = langid.Grams()
    assert [langid.features(word, grams.__getitem__) for word in ("straße", "straßen", "señor")] == plain
    assert len(hashed) == len(set(hashed))
    words = langid.Words(langid.Model(["de", "en"], np.zeros((langid.BUCKETS, 2), np.float32), {"latin": np.ones(2, bool)}))
    hashed.clear()
    words.of(["katze"])
    words.of(["katzen"])
    assert len(hashed) == len(set(hashed))
    monkeypatch.setattr(langid, "GRAMS", 3)
    small = langid.Grams()
    assert [small[g] for g in ("ab", "bc", "cd", "de", "ab")] == [langid.bucket(g) for g in ("ab", "bc", "cd", "de", "ab")]
    assert len(small) <= 3
