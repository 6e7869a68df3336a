"""Helpers shared by the operators: intermediate tables and values shared with workers."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import fresh_folder, shuffles_removed

BATCH = 4 << 20  # bytes of rows that go to Python together, about


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors. Texts are most of what is
    written, and zstd takes a third less disk for them than the default codec."""
    spark = df.sparkSession
    path = fresh_folder(spark, f"llm-{purpose}")
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_to = path
    return written


def emptied(*written: DataFrame) -> None:
    """Take the rows of tables that `materialize` made off the shared folder, once nothing is read from them any more."""
    for df in written:
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(df.written_to)


def release_memory() -> None:
    """Give memory that is free in this process back to the machine, where its allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def only(operator: str) -> dict:
    """What this worker process remembers for the operator; what it remembers for another one goes. Workers are used
    again by later stages, and idle ones stay, so that each function of an operator that follows another calls this."""
    store = sys.modules.setdefault("_tradewind_llm", types.ModuleType("_tradewind_llm")).__dict__
    if store.get("operator") != operator:
        store["operator"], store["kept"] = operator, {}
        release_memory()
    return store["kept"]


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python and back in batches of a few MB: a batch is held several times, by the executor and by each worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def aside(docs: DataFrame) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """doc_id and text of docs, with all other columns as one value under a name that clashes with none; and a
    function that makes the columns of docs from such rows again, in which named ones may be replaced."""
    others, kept = [c for c in docs.columns if c not in ("doc_id", "text")], f"kept_{uuid.uuid4().hex}"
    narrow = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in others), F.lit(0).alias(kept)).alias(kept))

    def back(rows: DataFrame, **replaced: Column) -> DataFrame:
        own = {c: F.col(c) if c in ("doc_id", "text") else F.col(kept)[c] for c in docs.columns}
        return rows.select(*(replaced.get(c, column).alias(c) for c, column in own.items()))

    return narrow, back


def first_rows(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each key: that with the least hash of its text."""
    others = [c for c in rows.columns if c != key]
    least = rows.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(F.xxhash64(text), F.col(text))).alias("_first"))
    return least.select(key, "_first.*")


def shared(spark: SparkSession, kind: str, value, make: Callable = lambda value: value) -> Callable:
    """Broadcast a value of bounded size. The function returned gives workers what `make` derives from it,
    once for each worker process; of each kind a process keeps the last one only. A process outlives the
    operator, which the first word of `kind` names: what one operator remembers goes when the next one starts."""
    # classes go by value, as functions do
    sent, key = spark.sparkContext.broadcast(cloudpickle.dumps(value)), uuid.uuid4().hex
    operator = kind.split()[0]

    def get():
        kept = only(operator)
        if kept.get(kind, ("",))[0] != key:
            kept.pop(kind, None)
            kept[kind] = (key, make(pickle.loads(sent.value)))
        return kept[kind][1]

    return get
