"""Prefix trie, document fingerprints and hard negatives against brute force, on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import exact, hard_negatives, minhash, prefix_trie

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def tried(rows):
    """Node report by brute force; rows: conv_id, turn, role, text."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(r, t) for *_, r, _, t in sorted(x)] for c, x in own.items()}
    made = {}
    for c, x in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = turns.get(c - c % 20, [])[:h] + x[h:]
    members = {}
    for c, x in made.items():
        for d in range(len(x) + 1):
            members.setdefault(tuple(x[:d]), []).append(c)
    out = []
    for node, own in members.items():
        subtree = [n for n in members if n[:len(node)] == node]
        child = [n for n in members if len(n) == len(node) + 1 and n[:-1] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in subtree if n)
        ending = ",".join(str(c) for c in sorted(own) if len(made[c]) == len(node))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(child),
                    sum(not any(m[:-1] == n for m in members if m) for n in subtree), saved, hashlib.sha256(ending.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id bigint, turn bigint, role string, text string, depth string, path int"


def report(df):
    heads = F.crc32(F.col("conv_id").cast("string")) % 4
    return prefix_trie.node_report(prefix_trie.rebuilt(df, heads, most=3, family=20))


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(90), 45):
        same = pick.random() < 0.4
        for turn in range(pick.randint(1, 9)):
            text = "a b" if same else pick.choice(["a b", "c", "", None, " x\ty z "])
            rows.append((c, pick.choice([turn, turn, None]), pick.choice(["user", None]) if not same else "user", text))
    rows += [(3, 1, "user", "twice"), (3, 1, "user", "twice"), (None, 0, "user", "nobody"), (200, 0, "user", "own head"),
             *((400, t, "user", "long " * 300) for t in range(40))]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], TURNS)
    got = sorted((tuple(r) for r in report(df).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                      "saved_tokens", "ends_sha256").collect()), key=str)
    assert got == tried(rows)


def test_trie_of_an_empty_table_and_of_one_turnless_conversation(spark):
    assert report(spark.createDataFrame([], TURNS)).count() == 0
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    row, = report(spark.createDataFrame([(alone, 0, "user", "given away", None, None)], TURNS)).collect()
    assert (row["conv_id"], row["depth"], row["parent_conv_id"], row["n_leaves"]) == (alone, 0, None, 1)
    assert row["ends_sha256"] == hashlib.sha256(str(alone).encode()).hexdigest()


def test_two_fattest_numbers(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a int, b int").select("a", "b", prefix_trie.fattest(F.col("a"), F.col("b")).alias("f"))
    for a, b, f in df.collect():
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_located_exit_points(spark):
    """The handles lead every path, in the trie or not, to where it leaves the trie."""
    pick = random.Random(5)
    marks = [hashlib.sha256(bytes([i])).digest() for i in range(3)]

    def path(turns):
        out = [prefix_trie.ROOT]
        for t in turns:
            out.append(hashlib.sha256(out[-1] + marks[t]).digest()[:prefix_trie.SIZE])
        return out

    held = [path([pick.choice([0, 0, 0, 1]) for _ in range(pick.randint(0, 14))]) for _ in range(60)]
    held = list({p[-1]: p for p in held}.values())
    nodes, _ = prefix_trie.build(spark.createDataFrame([(p[-1], p) for p in held], "name binary, path array<binary>"))
    every = {x for p in held for x in p}
    asked = [path([pick.choice([0, 0, 1, 2]) for _ in range(pick.randint(0, 14))]) for _ in range(80)]
    df = spark.createDataFrame([(p, 0) for p in asked], "path array<binary>, low int")
    for row in prefix_trie.locate(df, nodes, 4).collect():
        assert row["exit"] == sum(bytes(x) in every for x in row["path"]) - 1
    # compacted: every inner node is an end or a place where conversations part
    depths = {bytes(r["end"]): r["depth"] for r in nodes.select("end", "depth").collect()}
    ups = [bytes(r["up"]) for r in nodes.where("depth > 0").select("up").collect()]
    names = {p[-1] for p in held}
    assert len(depths) == nodes.count() and all(n in names or ups.count(n) > 1 or d == 0 for n, d in depths.items())


def shingled(text, size=5):
    words = [w for w in SPACE.split((text or "").lower()) if w]
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def printed(spark):
    pick = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(pick.choices(words, k=pick.choice([1, 3, 5, 40, 150, 400, 1500]))) for _ in range(60)]
    texts += [texts[5], texts[5], None, "", " \n", "naïve 𝔘 CAFÉ — 中文", "one", "x" * 200_000, "a b c d e f " * 20_000]
    ids = pick.sample(range(-50, 900), len(texts) - 2) + [None, None]
    rows = list(zip(ids, texts, strict=True)) + [(ids[3], texts[3]), (ids[4], "another text of one id")]
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id bigint, text string, n_chars string, fingerprint int")
    return rows, minhash.fingerprints(df).collect()


def test_edited_texts_take_from_the_next_document(printed):
    rows, got = printed
    key = {r: hashlib.sha256(f"{'none' if r[0] is None else r[0]} {r[1] or ''}".encode()).digest() for r in rows}
    chain = sorted(set((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(
        f"{'none' if r[0] is None else r[0]} {r[1]}".encode()).digest()))
    assert key
    want = []
    for i, t in [(i, t or "") for i, t in rows]:
        after = chain[(chain.index((i, t)) + 1) % len(chain)][1]
        take = len(t) // 3
        want.append((i, len(t), hashlib.sha256((t[:len(t) - take] + after[:take]).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == sorted(want, key=str)


def test_likeness_estimates_jaccard(printed):
    rows, got = printed
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    texts = {i: t or "" for i, t in rows}
    ordered = sorted((i for i in texts if i is not None), reverse=True)
    twice = {i for i in texts if [j for j, _ in rows].count(i) > 1}
    off = []
    for i, after in zip(ordered, ordered[1:], strict=False):
        if i in twice or after in twice:
            continue
        take = len(texts[i]) // 3
        edited = texts[i][:len(texts[i]) - take] + texts[after][:take]
        off.append(by_id[i]["near_edited"] - jaccard(shingled(texts[i]), shingled(edited)))
        off.append(by_id[i]["near_next"] - jaccard(shingled(texts[i]), shingled(texts[after])))
    assert np.abs(off).max() < 0.15 and np.sqrt(np.mean(np.square(off))) < 0.04 and abs(np.mean(off)) < 0.01
    same = {}
    for i, t in rows:
        same.setdefault(t or "", set()).update(r["fingerprint"] for r in got if r["doc_id"] == i and i is not None and i not in twice)
    assert all(len(prints) <= 1 for prints in same.values())
    assert {r["fingerprint"] for r in got if r["n_chars"] == 0} == {""}


def test_densified_bins_follow_their_own_order(spark):
    """An empty bin takes the first that is not empty of its own sequence, so a text loses no bin to another's."""
    rows = [([None] * 60 + [7] + [None] * 3,), ([i if i % 3 else None for i in range(64)],)]
    df = spark.createDataFrame(rows, "least array<bigint>").select("least", minhash.densified(F.col("least"), 64).alias("full"))
    one, many = df.collect()
    assert one["full"] == [7] * 64
    assert all(f == v if v is not None else f in many["least"] for v, f in zip(many["least"], many["full"], strict=True))
    taken = [f for v, f in zip(many["least"], many["full"], strict=True) if v is None]
    assert len(set(taken)) > len(taken) // 2  # drawn, not borrowed from a neighbour


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_few_bits_are_corrected_for_chance(spark, bits):
    words = [f"w{i}" for i in range(4000)]
    pairs = [(" ".join(words[:2000]), " ".join(words[500:2500])), (" ".join(words[:1500]), " ".join(words[2000:])), ("", ""), ("", "x")]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        minhash.likeness(*(minhash.fingerprint(F.col(c), 1024, bits) for c in ("a", "b")), 1024, bits).alias("near"), "a", "b")
    found = df.collect()
    for row in found[:2]:
        assert abs(row["near"] - jaccard(shingled(row["a"]), shingled(row["b"]))) < 0.1
    assert [r["near"] for r in found[2:]] == [1.0, 0.0]


def test_fingerprints_of_an_empty_table_and_no_python_in_the_plan(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert minhash.fingerprints(df).count() == 0
    plan = df.select(minhash.fingerprint(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def mined(rows, k=5, every=100, low=80, high=100):
    """Hard negatives by scoring all; rows: vec_id, vector of integers, label."""
    out = []
    for a, x, label in rows:
        if a % every:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), i, other) for i, y, other in rows if i != a)
        for ps, positive, _ in [s for s in scores if s[2] == label][:k]:
            fit = [(s, i) for s, i, other in scores if other != label and low * -ps <= 100 * -s <= high * -ps]
            out += [(a, positive, n + 1, i, -ps, -s) for n, (s, i) in enumerate(fit[:k])]
    return sorted(out)


def check_mined(spark, rows, **sizes):
    df = spark.createDataFrame([(i, [float(x) / 256 for x in v], label, 1, "s") for i, v, label in rows],
                               "vec_id bigint, embedding array<double>, label int, rank int, score string")
    got = sorted(tuple(r) for r in hard_negatives.mine(df, **sizes).collect())
    assert got == mined(rows, **{k: v for k, v in sizes.items() if k in ("every",)})


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    random_ = np.random.default_rng(3)
    rows = [(int(i), random_.integers(-40, 60, 12).tolist(), int(random_.integers(0, 3))) for i in range(500)]
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(60)]  # one vector under many ids
    rows += [(2000, [0] * 12, 1), (2100, [5] * 4, 2), (2200, [-1] * 12, 9)]
    check_mined(spark, rows)
    for name, value in (("SHARD", 90), ("LEAST", 40), ("BLOCK", 2), ("FIRST", 2)):
        monkeypatch.setattr(hard_negatives, name, value)
    check_mined(spark, rows)


def test_hard_negatives_of_large_components_are_exact(spark):
    big = 256 * 10_000_000
    rows = [(0, [big, 1, 3], 0), (100, [big, 2, 1], 0), (1, [big - 1, 5, 9], 1), (2, [big - 1, 5, 8], 1), (3, [128, 0, 0], 1)]
    rows = [(i, [x // 4 for x in v], label) for i, v, label in rows]  # scores of 60 bits
    check_mined(spark, rows)


def test_hard_negatives_of_odd_rows(spark):
    schema = "vec_id bigint, embedding array<double>, label int"
    assert hard_negatives.mine(spark.createDataFrame([], schema)).count() == 0
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9], 2), (2, [0.9], 2), (3, [float("nan")], 2),
            (4, [None, 1.0], 2), (5, None, 2), (6, [0.9, 0.0], None), (None, [0.9, 0.0], 2), (7, [], 2), (8, [float("inf")], 2)]
    assert [tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, schema)).collect()] == [(0, 1, 1, 2, 65536, 58880)]


def test_products_are_exact_at_every_size():
    random_ = np.random.default_rng(1)
    for size in (1 << 8, 1 << 29, 1 << 31):
        a, b = random_.integers(-size, size, (5, 3)), random_.integers(-size, size, (4, 3))
        assert exact.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    with pytest.raises(OverflowError):
        exact.products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def test_threshold_never_hides_a_better_row():
    random_ = np.random.default_rng(2)
    vectors = np.concatenate([random_.integers(-9, 9, (300, 6)), np.tile([3, 0, 1, 0, -2, 4], (80, 1))])
    shard = hard_negatives.Shard(np.arange(380)[::-1].copy(), np.zeros(380, int), vectors)
    asked = np.concatenate([random_.integers(-5, 5, (30, 6)), np.zeros((1, 6), int)])
    for anchor, limits in zip(asked, shard.thresholds(asked), strict=True):
        windows = [(-np.inf, np.inf), (10, 30), (0, 0), (1000, 2000)]
        found = shard.search(anchor, limits, -1, np.ones(380, bool), windows, 5)
        for (low, high), (ids, scores) in zip(windows, found, strict=True):
            want = sorted((-s, i) for i, s in zip(shard.ids.tolist(), (shard.vectors @ anchor).tolist(), strict=True) if low <= s <= high)[:5]
            assert list(zip((-scores).tolist(), ids.tolist(), strict=True)) == want
