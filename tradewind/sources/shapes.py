"""Parquet files whose column types differ: physical schemas read by tasks, and what converts to what.

Files are grouped by physical schema and each group is read on its own, so no schema of all files is merged and a
file of another type does not end the load. Whether a column converts is decided once for each pair of types; where
only some values can, each row is judged.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradewind.functions.temporal import parse_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

SHAPES = 1000  # different schemas in one load, at most
SHAPE = "path string, shape string, columns array<string>, problem string"
# Schemes whose footers pyarrow reads in place; files elsewhere are read whole by Spark.
IN_PLACE = ("file", "hdfs", "viewfs", "s3", "s3a", "gs")


def _described(path: str, source) -> tuple[str, str | None, list[str] | None, str | None]:
    import pyarrow.parquet as parquet

    try:
        schema = parquet.read_schema(source)
    except Exception as error:  # of one file: it is reported with its path, and the others are loaded
        return path, None, None, f"{type(error).__name__}: {error}"
    # field order does not matter, names and types do
    return path, "; ".join(sorted(f"{f.name} {f.type}" for f in schema)), schema.names, None


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.list_(pa.string()), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)], names=["path", "shape", "columns", "problem"])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            try:
                uri = path.replace("s3a://", "s3://", 1) if "://" in path else path.replace("file:/", "file:///", 1)
                system, inner = fs.FileSystem.from_uri(uri)
                with system.open_input_file(inner) as source:
                    found.append(_described(path, source))
            except (OSError, pa.ArrowInvalid) as error:
                found.append((path, None, None, f"{type(error).__name__}: {error}"))
        yield _batch(found)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _batch([_described(path.as_py(), pa.BufferReader(content.as_buffer()))
                      for path, content in zip(batch.column("path"), batch.column("content"), strict=True)])


def physical_schemas(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, shape (names and types as one text), columns, problem (why the footer cannot be read) of each file."""
    here = [path for path in paths if path.split(":", 1)[0] in IN_PLACE or path.startswith("/")]
    rest = sorted(set(paths) - set(here))
    listed = spark.createDataFrame([(path,) for path in here], "path string")
    # a footer is a read of its own, so files are spread over tasks
    found = listed.repartition(max(1, min(len(here), spark.sparkContext.defaultParallelism))).mapInArrow(_footers, SHAPE)
    if rest:
        whole = spark.read.format("binaryFile").load(rest).select("path", "content")
        found = found.unionByName(whole.mapInArrow(_contents, SHAPE))
    return found


# From narrow to wide. A value of one converts to those to its right without loss.
WIDTHS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def convertible(found: T.DataType, wanted: T.DataType) -> str:
    """How values of a column get to the wanted type: "same" and "widens" always, "parses" and "narrows" where the
    value allows it, "unfit" never."""
    if found == wanted or isinstance(found, T.NullType):
        return "same"
    if isinstance(wanted, T.StringType):
        return "widens"
    if isinstance(found, T.StringType):
        return "parses" if not isinstance(wanted, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) else "unfit"
    if isinstance(found, T.IntegralType) and isinstance(wanted, T.IntegralType):
        return "widens" if WIDTHS.index(type(found)) < WIDTHS.index(type(wanted)) else "narrows"
    if isinstance(found, T.FloatType) and isinstance(wanted, T.DoubleType):
        return "widens"
    if isinstance(found, T.DecimalType) and isinstance(wanted, T.DecimalType):
        whole = wanted.precision - wanted.scale >= found.precision - found.scale
        return "widens" if whole and wanted.scale >= found.scale else "narrows"
    if isinstance(found, T.NumericType) and isinstance(wanted, T.NumericType):
        return "narrows"
    times = (T.TimestampType, T.TimestampNTZType)
    if isinstance(found, (T.DateType, *times)) and isinstance(wanted, times):
        return "widens"
    if isinstance(found, times) and isinstance(wanted, T.DateType):
        return "narrows"
    return "unfit"


def _text(name: str, kind: T.DataType) -> Column:
    nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(F.col(name)) if nested else F.col(name).cast("string")


def converted(name: str, found: T.DataType, wanted: T.DataType) -> tuple[Column, Column]:
    """The column in the wanted type (NULL where it does not convert), and whether the value is lost."""
    value, how = F.col(f"`{name}`"), convertible(found, wanted)
    if how == "same":
        return value.cast(wanted), F.lit(False)
    if how == "unfit":
        return F.lit(None).cast(wanted), value.isNotNull()
    if how == "widens":
        return (_text(f"`{name}`", found) if isinstance(wanted, T.StringType) else value.cast(wanted)), F.lit(False)
    made = parse_time(f"`{name}`") if isinstance(wanted, T.TimestampType) else value.try_cast(wanted)
    lost = made.isNull()
    if how == "narrows":
        lost = lost | ~made.try_cast(found).eqNullSafe(value)
    return made, value.isNotNull() & lost


def fitted(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that convert, in the types of ``schema`` (columns matched by name whatever the case, missing ones NULL),
    and the rejected rest with every column as text and ``_rejected``, the columns that do not convert."""
    present = {field.name.lower(): field for field in rows.schema.fields}
    made, problems = {}, []
    for field in schema.fields:
        source = present.get(field.name.lower())
        if source is None:
            made[field.name] = F.lit(None).cast(field.dataType)
            continue
        made[field.name], lost = converted(source.name, source.dataType, field.dataType)
        problems.append(F.when(lost, F.lit(field.name)))
    judged = rows.withColumn("_rejected", F.concat_ws(",", *problems) if problems else F.lit(""))
    good = judged.where(F.col("_rejected") == "").select(*[column.alias(name) for name, column in made.items()])
    named = {field.name.lower(): field.name for field in schema.fields}
    texts = [_text(f"`{field.name}`", field.dataType).alias(named.get(field.name.lower(), field.name)) for field in rows.schema.fields]
    return good, judged.where(F.col("_rejected") != "").select(*texts, "_rejected")


def read_groups(spark: SparkSession, files: DataFrame) -> list[DataFrame]:
    """One DataFrame for each physical schema among the files of ``physical_schemas``; the paths of one load reach
    the driver. The footer of one file stands for its group."""
    groups = (files.where(F.col("shape").isNotNull()).groupBy("shape")
              .agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("shape").limit(SHAPES + 1).collect())
    if len(groups) > SHAPES:
        raise ValueError(f"more than {SHAPES} different schemas in one load")
    return [spark.read.parquet(*group["paths"]) for group in groups]
