"""From an event topic to an hourly partitioned table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tradewind import schemas
from tradewind.functions.temporal import hour_partitions

# How the topics are read and written unless told otherwise.
TRIGGER = "30 seconds"
OFFSETS_PER_TRIGGER = 1000

# What a broker delivers. A file source with these columns stands in for it where there is none.
BROKER_ROW = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def read_topic(spark: SparkSession, topic: str, servers: str, per_trigger: int | None = None,
               start: str = "earliest", fail_on_data_loss: bool = True) -> DataFrame:
    """Broker rows of a topic, without a rate limit unless ``per_trigger`` (such as
    ``OFFSETS_PER_TRIGGER``) sets one; lost offsets are an error unless ``fail_on_data_loss`` is off."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", start).option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def read_topic_files(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Broker rows kept as Parquet files, as a stream."""
    reader = spark.readStream.schema(BROKER_ROW)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def parse_topic(raw: DataFrame, payload: T.StructType) -> DataFrame:
    """Broker metadata, payload fields, ingest time and hour partitions. A payload that is not
    valid JSON yields NULL fields; staging drops such rows."""
    decoded = raw.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.from_json(F.col("value").cast("string"), payload).alias("data"),
    )
    return (
        decoded.select(*schemas.BROKER_COLUMNS, "data.*")
        .withColumn("ingested_at", F.current_timestamp())
        .withColumns(hour_partitions(F.col("kafka_timestamp")))
    )


def land(parsed: DataFrame, path: str, checkpoint: str, format: str = "parquet",
         trigger: Mapping | None = None) -> StreamingQuery:
    """Append to the landed table, one folder per hour of broker time.

    The checkpoint makes a restarted query continue where it stopped; both the Parquet and the
    Delta sink commit a batch once.
    """
    return (
        parsed.writeStream.format(format).outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy(*schemas.HOUR_PARTITIONS)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )


@dataclass(frozen=True)
class TopicJob:
    topic: str
    rows: DataFrame
    path: str
    checkpoint: str


def land_topics(jobs: list[TopicJob], format: str = "parquet", trigger: Mapping | None = None) -> list[StreamingQuery]:
    """One query per topic in a shared session."""
    return [
        land(parse_topic(job.rows, schemas.TOPICS[job.topic]), job.path, job.checkpoint, format, trigger)
        for job in jobs
    ]


def landed_table(spark: SparkSession, topic: str, path: str) -> DataFrame:
    """The landed rows committed so far, without the partition columns."""
    return spark.read.parquet(path).select(*schemas.landed(topic).names)
