"""Loading landed topic files into the raw table: discover, stage, gate, publish, remember."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tradewind.operators.quality import Check
from tradewind.sources import publish, sinks, state
from tradewind.sources.discovery import each_part
from tradewind.sources.shapes import fitted, physical_schemas, read_groups

LOAD = "load_id"


@dataclass(frozen=True)
class TopicLayout:
    """Folders of a topic. What is staged, the progress of discovery and check results lie beside them."""

    landed: str
    table: str
    rejects: str
    manifest: str

    @property
    def staging(self) -> publish.Staging:
        return publish.Staging(f"{self.table}-staged", self.table, f"{self.table}-results")

    @property
    def progress(self) -> str:
        return f"{self.manifest}-progress"

    @property
    def found(self) -> str:
        return f"{self.manifest}-found"


def _stage_part(layout: TopicLayout, schema: StructType):
    """Stage the rows of a part of the new files and put those aside that do not convert."""
    def take(found: DataFrame, load_id: int) -> None:
        spark = found.sparkSession
        paths = [row["path"] for row in found.select("path").collect()]  # at most files_per_load
        shaped = spark.createDataFrame(physical_schemas(spark, paths).collect(), "path string, shape string, columns array<string>, problem string")
        good, refused = [], []
        for rows in read_groups(spark, shaped):
            traced = rows.withColumn("_source_file", F.col("_metadata.file_path")).withColumn("_loaded_at", F.current_timestamp())
            kept, bad = fitted(traced, schema)
            good.append(kept)
            refused.append(bad)
        # a file that cannot be read is one rejected entry
        refused.append(shaped.where(F.col("problem").isNotNull()).select(
            F.col("path").alias("_source_file"), F.col("problem").alias("_problem"), F.lit("").alias("_rejected")))
        empty = spark.createDataFrame([], schema)
        publish.stage(reduce(DataFrame.unionByName, good, empty), layout.staging, LOAD, load_id)
        sinks.replace_partition(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), refused), layout.rejects, LOAD, load_id)
        # last, so that a part counts as found only with all its rows
        sinks.replace_partition(shaped.select("path", "columns"), layout.found, LOAD, load_id)

    return take


def pending_loads(spark: SparkSession, layout: TopicLayout) -> list[int]:
    """Numbers of staged parts that are not published."""
    found = state.read_state(spark, layout.found, state.FOUND).select(LOAD).distinct()
    done = state.manifest(spark, layout.manifest).select(LOAD).distinct()
    return sorted(row[LOAD] for row in found.join(done, LOAD, "left_anti").collect())


def load_new_files(spark: SparkSession, topic: str, layout: TopicLayout, schema: StructType,
                   checks: Sequence[Check] = (), parents: Mapping[str, DataFrame] | None = None,
                   files_per_load: int = 10_000) -> int:
    """Load every landed file that no earlier load took; returns the number of loads published.

    New files come from a checkpointed listing, ``files_per_load`` at a time, so no more paths than that are held.
    Each part is staged: files are read in groups of one physical schema, and rows that do not convert go to
    ``rejects`` with the names of the columns (a file that cannot be read goes there as an entry with the problem).
    All staged parts are then judged together, whatever their number: nothing is published unless all of them
    pass. Structure checks see the columns the files have. Table, rejects and manifest are written per load number:
    a repeated load replaces its own partition and duplicates nothing. Loads that are refused stay staged, and the
    next run judges them again together with what is new; ``set_aside`` gives them up.
    """
    each_part(spark, layout.landed, layout.progress, files_per_load, _stage_part(layout, schema))
    loads = pending_loads(spark, layout)
    if not loads:
        return 0
    found = state.read_state(spark, layout.found, state.FOUND).where(F.col(LOAD).isin(loads))
    columns = [row["name"] for row in found.select(F.explode("columns").alias("name")).distinct().orderBy("name").collect()]
    seen = {name.lower() for name in columns}
    known = {field.name.lower() for field in schema.fields}

    def as_found(rows: DataFrame) -> DataFrame:
        extra = [F.lit(None).alias(name) for name in columns if name.lower() not in known]
        return rows.select(*[field.name for field in schema.fields if field.name.lower() in seen], *extra)

    publish.publish(spark, topic, layout.staging, LOAD, loads, checks, parents, as_found)
    for load_id in loads:
        state.mark_loaded(found.where(F.col(LOAD) == load_id), layout.manifest, load_id)
    publish.clear(spark, layout.staging, LOAD, loads)
    return len(loads)


def set_aside(spark: SparkSession, layout: TopicLayout, loads: Sequence[int]) -> None:
    """Give up staged loads that a gate refused: their rows go to the rejects as text, their files count as loaded."""
    for load_id in loads:
        rows = publish.staged_rows(spark, layout.staging, LOAD, [load_id]).drop(LOAD)
        texts = rows.select(*[F.col(name).cast("string").alias(name) for name in rows.columns], F.lit("gate").alias("_rejected"))
        before = spark.read.option("mergeSchema", "true").parquet(layout.rejects).where(F.col(LOAD) == load_id).drop(LOAD)
        both = texts.unionByName(before.where(F.col("_rejected") != "gate"), allowMissingColumns=True)
        sinks.replace_partition(both, layout.rejects, LOAD, load_id)
        found = state.read_state(spark, layout.found, state.FOUND).where(F.col(LOAD) == load_id)
        state.mark_loaded(found, layout.manifest, load_id)
    publish.clear(spark, layout.staging, LOAD, loads)
