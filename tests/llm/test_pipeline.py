"""The pipeline on odd rows, and its first stages against what they must keep."""

import itertools
import pathlib
import random
import sys
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tradewind.llm import langid, near_copies, suffix_dedup
from tradewind.llm.common import emptied, materialize, shared


def test_stages_keep_the_columns_and_do_their_work(spark):
    text = "Der Hund und die Katze sind im Haus und der Mann ist bei der Frau in dem Garten mit dem Kind " * 4
    rows = [(i, f"{text} {i} mail me{i}@site.org", "de", "s", 5) for i in range(6)]
    rows += [(10, None, "en", "s", None), (11, "", "en", None, 0), (12, "12345 !!", "en", "s", 8), (13, rows[0][1], "de", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, docs, ""), name)
        assert after.columns == docs.columns
        empty = stage(spark, docs.limit(0), "")
        assert empty.count() == 0 and empty.columns == docs.columns
        kept = {r["doc_id"] for r in after.collect()}
        assert not kept & {10, 11, 12, 13} if name != "language" else not kept & {10, 11, 12} and 13 in kept
        docs = after
    assert 0 in kept and not docs.where("text like '%@%'").count()
    assert docs.where("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.packed(spark, docs, "")
    assert {r["doc_id"] for r in packed.collect()} == kept


def plain_shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies_equal_brute_force(spark, monkeypatch):
    # one word in 40 to 120 changed: similarity around 0.8; one line in most texts, one group larger than HOT
    monkeypatch.setattr(near_copies, "HOT", 8)
    monkeypatch.setattr(near_copies, "PART", 500)
    words = random.Random(1)
    made = lambda n: [f"w{words.randrange(3000)}" for _ in range(n)]
    line, texts = made(9), []
    for group in range(40):
        base = made(words.randrange(30, 120)) + (line if group % 3 else [])
        for _ in range(30 if group == 1 else words.randrange(1, 5)):
            own = list(base)
            for _ in range(words.randrange(0, 4)):
                own[words.randrange(len(own))] = made(1)[0]
            texts.append(" ".join(own[:words.randrange(len(own) * 3 // 4, len(own) + 1)] if words.random() < 0.3 else own))
    texts += [" ".join(made(3)) for _ in range(5)] + texts[::9]
    words.shuffle(texts)
    sets = [plain_shingles(t) for t in texts]
    label = list(range(len(texts)))
    find = lambda i: i if label[i] == i else find(label[i])
    alike = [len(a & b) / len(a | b) for a, b in itertools.combinations(sets, 2)]
    for (i, j), share in zip(itertools.combinations(range(len(texts)), 2), alike, strict=True):
        if share >= 0.8 and find(i) != find(j):
            label[max(find(i), find(j))] = min(find(i), find(j))
    assert sum(0.8 <= share < 1 for share in alike) > 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert kept == {i for i in range(len(texts)) if find(i) == i}


def test_rows_of_one_id_and_clashing_columns(spark):
    """Different texts under one id stay; copies under null ids are one; columns may be named like anything."""
    random_ = random.Random(2)
    made = lambda: " ".join(random_.choice(["der", "die", "und", "Haus", "mit", "Kind", "Garten"]) + str(random_.randrange(9)) for _ in range(60))
    a, b, c = made(), made(), made()
    texts = [(5, a), (5, b), (5, b), (None, c), (None, c), (6, a), (None, None), (9, "")]
    names = ["point", "_set", "component", "component_id", "_n", "row", "shelf", "_text", "n_bytes", "kept_text", "found", "nth",
             "_language", "_pii", "lang", "token", "n"]
    rows = [(i, t, *(["de"] * len(names))) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(5, a), (5, b), (None, c), (9, "")], key=str)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns and {r["point"] for r in after.collect()} <= {"de"}


def test_repeated_passages_are_dealt_in_small_parts():
    """A task holds one part several times, so a part of 16 MB took an executor over 3000 MB on half a gigabyte."""
    assert (512 << 20) / suffix_dedup.parts_of(512 << 20) <= 4 << 20
    assert suffix_dedup.parts_of(0) == 8


def test_points_of_frequent_shingles_meet_in_blocks(spark, monkeypatch):
    """However many points frequent shingles connect, a task gets two blocks of them, and any two points meet once or more."""
    monkeypatch.setattr(near_copies, "BLOCK", 100)
    members = spark.createDataFrame([(i, 0) for i in range(200)], "point bigint, component bigint")
    own = spark.createDataFrame([(i, f"t{i}", 10) for i in range(200)], "point bigint, text string, n int")
    met = {}
    for row in near_copies.in_blocks(members, own).collect():
        met.setdefault((row["x"], row["y"]), set()).add(row["point"])
    assert max(map(len, met.values())) < 60
    assert {pair for part in met.values() for pair in itertools.combinations(sorted(part), 2)} == set(
        itertools.combinations(range(200), 2))


def test_near_copies_in_blocks_equal_those_in_one(spark, monkeypatch):
    """A chain of texts, similar only to their neighbours, that one frequent line connects."""
    monkeypatch.setattr(near_copies, "HOT", 4)
    line = [f"line{i}" for i in range(40)]
    texts = [" ".join(line + [f"w{j}" for j in range(i, i + 60)]) for i in range(0, 120, 3)]
    texts += [" ".join(line + [f"v{k}x{j}" for j in range(8)]) for k in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    whole = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()}
    sets = [plain_shingles(t) for t in texts]
    assert all((whole[i] == whole[j]) for i, j in itertools.combinations(range(len(texts)), 2)
               if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8)
    monkeypatch.setattr(near_copies, "BLOCK", 500)
    assert {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()} == whole


def test_written_texts_are_packed_and_tables_without_use_are_emptied(spark, monkeypatch):
    text = " ".join(f"word{i % 700} {i}" for i in range(3000))
    docs = spark.createDataFrame([(i, f"{i} {text}") for i in range(20)], "doc_id bigint, text string")
    size = lambda path: sum(f.stat().st_size for f in pathlib.Path(path.removeprefix("file:")).glob("*.parquet"))
    written = materialize(docs.coalesce(1), "packed")
    plain = f"{written.written_to}-plain"
    docs.coalesce(1).write.parquet(plain)
    assert size(written.written_to) < 0.8 * size(plain) and written.count() == 20
    emptied(written)
    assert size(written.written_to) < 2000 and spark.read.parquet(written.written_to).count() == 0

    made = {}
    def noted(df, purpose):
        made.setdefault(purpose, []).append(materialize(df, purpose))
        return made[purpose][-1]
    monkeypatch.setattr(near_copies, "materialize", noted)
    assert near_copies.near_copies(docs).select("component_id").distinct().count() == 1
    for purpose in ("points", "frequent", "met"):
        assert [spark.read.parquet(df.written_to).count() for df in made[purpose]] == [0], purpose


def test_workers_forget_what_the_stage_before_remembered(spark):
    """Workers outlive a stage: those with the words of `language` took an executor over 3000 MB in the stages behind it."""
    described = near_copies.described(5).func
    token = [x.tobytes() for x in (pd.Series([1, 1]).to_numpy(), pd.Series([3, 4]).to_numpy(), pd.Series([9, 9]).to_numpy(), pd.Series([0, 0]).to_numpy())]
    met = pa.table({name: pa.array([x], pa.binary()) for name, x in zip(("token", "point", "n", "at"), token, strict=True)})
    docs = pa.RecordBatch.from_pydict({"doc_id": [1], "row": [0], "text": ["a b c"]})
    for run in (lambda: list(described(iter([pd.Series(["a b", None])]))), lambda: near_copies.meet(met),
                lambda: list(suffix_dedup.find_anchors(50, 16, 8)(iter([docs])))):
        assert shared(spark, "langid", ["words"])() == ["words"]
        assert "langid" in sys.modules["_tradewind_llm"].kept
        run()
        assert "langid" not in sys.modules["_tradewind_llm"].kept


def test_a_task_that_deals_prefixes_needs_one_worker(spark, monkeypatch):
    plans = {}
    def noted(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, purpose)
    monkeypatch.setattr(near_copies, "materialize", noted)
    docs = spark.createDataFrame([(i, f"a b c d e f g {i}") for i in range(9)], "doc_id bigint, text string")
    near_copies.near_copies(docs).count()
    assert plans["met"].index("Union") < plans["met"].index("MapInArrow")


def test_rows_go_to_python_in_small_batches(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab cd "), 2000).alias("text")).coalesce(1)
    corpus_pipeline.near_copies(spark, docs.limit(9), "").count()
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})
    found = [r["size"] for r in docs.mapInArrow(sizes, "size bigint").collect()]
    assert sum(found) > 30 << 20 and max(found) < 8 << 20


def test_languages_are_learned_from_all_labelled_rows(spark):
    """A quarter of the ids, rows without one and all but 4000 ids taught nothing, so that these documents were all rejected."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]
    text = "Der Hund und die Katze sind im Haus"
    docs = spark.createDataFrame([(i, f"{text} {i}", "de") for i in ids] + [(None, "Le chat est dans la maison", "fr")],
                                 "doc_id bigint, text string, lang string")
    assert langid.train(docs, at_most=None).languages == ["de", "fr"]
    assert corpus_pipeline.language(spark, docs, "").count() == len(ids) + 1
    one = langid.train(docs.where("lang = 'de'"), at_most=None)
    assert langid.identify(docs.limit(3), one, spans=False).where("language.lang_pred = 'de'").count() == 3


def test_passages_of_rows_without_an_id_of_their_own_go(spark):
    """Rows without an id were returned whole, and those of one id never lost what another one of them had."""
    words = random.Random(3)
    made = lambda: " ".join(f"w{words.randrange(10 ** 6)}" for _ in range(30))
    passage = made()
    texts = [(None, f"{made()} {passage} {made()}") for _ in range(3)] + [(5, f"{made()} {passage} {made()}") for _ in range(3)]
    texts += [(9, f"{made()} {passage}"), (9, made())]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    hashed = {r["text"]: r["h"] for r in docs.withColumn("h", F.xxhash64("doc_id", "text")).collect()}
    first = min((h, t) for (i, t), h in ((x, hashed[x[1]]) for x in texts) if i == 5)[1]
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()]
    assert len(kept) == len(texts) and [x for x in kept if passage in x[1]] == [(5, first)]
    assert sum(len(t) for _, t in kept) <= sum(len(t) for _, t in texts) - 6 * len(passage)
    # the operator on its own holds rows of one id for one document, and leaves rows without one alone
    alone = {r["text"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs, 50).collect()}
    assert [bool(alone[t]) for _, t in texts] == [False] * 6 + [True, False]


def test_ranks_of_rows_follow_ids_and_rows():
    doc, row = np.array([7, 2, 7, 2, 7]), np.array([5, -1, -3, -1, 5])
    assert suffix_dedup.order_of(doc, row, True).tolist() == [2, 0, 1, 0, 2]
    assert suffix_dedup.order_of(doc, row, False) is doc


def test_prefixes_that_meet_hold_different_pairs_only(spark):
    """Sixty near copies meet at each shingle of their prefixes; all these meetings were held until the end, several times."""
    n = 60 * 67 * 20
    token, point = np.arange(n) // 60, np.arange(n) % 60 + np.arange(n) // 60 // 67 * 60
    columns = {"token": token, "point": point, "n": np.full(n, 300), "at": np.full(n, 5)}
    table = pa.table({name: pa.array([x.astype("<i8").tobytes()], pa.binary()) for name, x in columns.items()})
    tracemalloc.start()
    met = near_copies.meet(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    pairs = {(a + 60 * group, b + 60 * group) for group in range(20) for a, b in itertools.combinations(range(60), 2)}
    assert met.num_rows == len(pairs) and set(zip(met["a"].to_pylist(), met["b"].to_pylist())) == pairs
    assert not any(met["hot"].to_pylist())
