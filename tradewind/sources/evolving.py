"""A table whose loads may differ in columns and types, read without opening a footer.

The schema of the table is kept as versions. A load that brings a new column or a wider type leads to a new version;
its rows are converted to the current version as they are written, so all files of one version have exactly its
schema. A read takes each version with its own schema, converts it to the newest and unites them by name.

Below the root lie ``versions``, ``rows`` (a folder per version and load) and ``loads``, which says under which version
a load was written. The last is written after the rows: what it does not name is not read, so a load that died is not
seen, and a load repeated under a later version counts once. One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradewind.sources.sinks import align, replace_partition
from tradewind.sources.state import read_state

# Decimal digits that hold every value of an integral type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
LOAD = "_load"  # not a name for a column of a load
VERSIONS = T.StructType([T.StructField("schema", T.StringType()), T.StructField("version", T.IntegerType())])
LOADS = T.StructType([T.StructField("generation", T.IntegerType()), T.StructField(LOAD, T.StringType())])


class SchemaConflict(ValueError):
    """Columns of a load whose type does not fit that of the table."""


def widest(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both without loss; None where there is none."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    kinds = {type(one), type(other)}
    if kinds <= {*DIGITS}:
        return max(one, other, key=lambda kind: DIGITS[type(kind)])
    if kinds <= {*DIGITS, T.DecimalType}:
        scales = [kind.scale if isinstance(kind, T.DecimalType) else 0 for kind in (one, other)]
        wholes = [kind.precision - kind.scale if isinstance(kind, T.DecimalType) else DIGITS[type(kind)] for kind in (one, other)]
        precision = max(wholes) + max(scales)
        return T.DecimalType(precision, max(scales)) if precision <= 38 else None
    if kinds <= {T.ByteType, T.ShortType, T.FloatType}:
        return T.FloatType()
    if kinds <= {T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType}:
        return T.DoubleType()  # integers of 64 bits would lose digits
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return None


def _nullable(schema: T.StructType) -> T.StructType:
    """The schema as files give it back: every field may be missing."""
    text = schema.json()
    for flag in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{flag}":false', f'"{flag}":true')
    return T.StructType.fromJson(json.loads(text))


def united(table: T.StructType, load: T.StructType) -> T.StructType:
    """The schema that holds both, columns matched by name whatever the case; new columns come last."""
    table, load = _nullable(table), _nullable(load)
    brought = {field.name.lower(): field for field in load.fields}
    if len(brought) < len(load.fields):
        raise SchemaConflict(f"a column name occurs twice in {load.names}")
    if LOAD in brought:
        raise SchemaConflict(f"{LOAD} names the load")
    fields, conflicts = [], []
    for field in table.fields:
        new = brought.pop(field.name.lower(), field)
        kind = widest(field.dataType, new.dataType)
        if kind is None:
            conflicts.append(f"{field.name}: {field.dataType.simpleString()} and {new.dataType.simpleString()}")
        fields.append(T.StructField(field.name, kind or field.dataType))
    if conflicts:
        raise SchemaConflict("; ".join(conflicts))
    return T.StructType(fields + list(brought.values()))


class EvolvingTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def versions(self) -> list[T.StructType]:
        """All versions of the schema, the newest last; their number is that of changes, not of loads."""
        kept = read_state(self.spark, f"{self.root}/versions", VERSIONS)
        return [T.StructType.fromJson(json.loads(row["schema"])) for row in kept.orderBy("version").collect()]

    def append(self, rows: DataFrame, load: str) -> int:
        """Adds the rows as one load, or replaces the load of this name; returns the version it is written under.

        Columns of type void are taken as text where no version knows their type. A type that does not fit raises
        ``SchemaConflict`` before anything is written.
        """
        known = self.versions()
        current = united(known[-1] if known else T.StructType(), rows.schema)
        current = T.StructType([T.StructField(field.name, T.StringType() if isinstance(field.dataType, T.NullType) else field.dataType)
                                for field in current.fields])
        if not known or current != known[-1]:
            version = self.spark.createDataFrame([(current.json(),)], "schema string")
            replace_partition(version, f"{self.root}/versions", "version", len(known))
            known.append(current)
        generation = len(known) - 1
        align(rows, current).write.mode("overwrite").parquet(f"{self.root}/rows/generation={generation}/{LOAD}={load}")
        entry = self.spark.createDataFrame([(generation,)], "generation int")
        replace_partition(entry, f"{self.root}/loads", LOAD, load)
        return generation

    def loads(self) -> DataFrame:
        """Loads that are complete, and the version each is written under."""
        return read_state(self.spark, f"{self.root}/loads", LOADS)

    def read(self) -> DataFrame:
        """All complete loads in the newest schema; columns a load did not have are NULL."""
        known, complete = self.versions(), self.loads()
        if not known:
            raise FileNotFoundError(f"no load below {self.root}")
        used = sorted(row["generation"] for row in complete.select("generation").distinct().collect())
        result = self.spark.createDataFrame([], known[-1])
        for generation in used:
            folder = f"{self.root}/rows/generation={generation}"
            # the load is a partition, so only folders of complete loads are scanned
            stored = T.StructType([*known[generation].fields, T.StructField(LOAD, T.StringType())])
            chosen = complete.where(F.col("generation") == generation).select(LOAD)
            part = self.spark.read.schema(stored).parquet(folder).join(chosen, LOAD, "left_semi")
            result = result.unionByName(align(part, known[-1]))
        return result
