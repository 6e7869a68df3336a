"""Named sources: where each raw table lives and what its columns are."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, TimestampType, StringType

from tradewind import schemas


@dataclass(frozen=True)
class Source:
    name: str
    schema: StructType
    format: str = "parquet"


def _with(schema: StructType, *fields: StructField) -> StructType:
    return StructType([*schema.fields, *fields])


SOURCES: Mapping[str, Source] = {
    **{name: Source(name, _with(schema, StructField("_ingested_at", TimestampType())))
       for name, schema in schemas.BATCH_TABLES.items()},
    **{topic: Source(topic, _with(schemas.landed(topic), StructField("_loaded_at", TimestampType()),
                                  StructField("_source_file", StringType())))
       for topic in schemas.TOPICS},
}


def read_source(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A declared source with its pinned schema: no inference, no footers read for planning."""
    source = SOURCES[name]
    return spark.read.format(source.format).schema(source.schema).load(f"{root}/{name}")


def register_sources(spark: SparkSession, root: str) -> list[str]:
    """A temporary view ``raw_<name>`` for every declared source."""
    for name in SOURCES:
        read_source(spark, root, name).createOrReplaceTempView(f"raw_{name}")
    return [f"raw_{name}" for name in SOURCES]
